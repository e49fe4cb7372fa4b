"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A vector's code says on which side of ``bits`` learned directions it lies: its direction is centred, turned to the main axes
and rotated so that the signs lose as little as possible (iterative quantisation). The code is cut into substrings of 16
bits, each with an index of its own. Codes within ``radius`` bits of a query's agree in some substring up to their share of
the radius, so probing every index at that share retrieves all of them; they are checked by the whole code, and what is left
is ranked by the exact cosine of the vectors themselves.

Rotations and radius are fitted, on a bounded sample: the rotations on at most FIT_ROWS vectors, the radius on at most PILOTS
queries, whose true neighbours among all rows are known from one pass. Every row is indexed. The index lies in stripes, each
in memory for as long as a cell of the grid is searched. A query that finds too few rows is asked again at a wider radius.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrata.llm.vectors import finite, grid, matrix, one_per_id
from quadrata.session import cut_lineage

K, BITS, CAUGHT = 5, 128, 0.97
FIT_ROWS, PILOTS, ROUNDS = 8192, 128, 40
_PAIRS = 1 << 16
_SUB = 16


def unit(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its square is neither nothing nor infinite; cosines stay the same."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.where((np.abs(exponent) > 400)[:, None], np.ldexp(vectors, -exponent[:, None]), vectors)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of two matrices, one by one; equal rows give equal results wherever they stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class Coder:
    """Learned rotations from vectors to binary codes."""

    def __init__(self, sample: np.ndarray, bits: int, seed: int = 42):
        self.bits, width = bits, sample.shape[1]
        rng = np.random.default_rng(seed)
        x = self._direction(sample)
        self.centre = x.mean(axis=0) if len(x) else np.zeros(width)
        x = x - self.centre
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
        parts = []
        while sum(p.shape[1] for p in parts) < bits:
            n = min(width, bits - sum(p.shape[1] for p in parts))
            v = x @ axes[:, :n]
            turn = np.linalg.qr(rng.normal(size=(n, n)))[0]
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
                turn = (left @ right).T
            parts.append(axes[:, :n] @ turn)
        self.turn = np.concatenate(parts, axis=1)

    @staticmethod
    def _direction(vectors: np.ndarray) -> np.ndarray:
        return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, bits / 16) substrings."""
        sides = (self._direction(vectors) - self.centre) @ self.turn >= 0
        return np.packbits(sides, axis=1, bitorder="little").view("<u2")


def shares(radius: int, parts: int) -> list[int]:
    """How far each substring is probed: whoever is within the radius is within its share somewhere (-1: not probed)."""
    share, rest = divmod(radius, parts)
    return [share if i <= rest else share - 1 for i in range(parts)]


def _masks(most: int, limit: int) -> np.ndarray | None:
    """All 16-bit masks of at most that many bits, or None if they are more than ``limit``."""
    every = np.arange(1 << _SUB, dtype=np.uint16)
    found = every[np.bitwise_count(every) <= most]
    return found if len(found) <= limit else None


class Index:
    """Substring indexes of the codes of one stripe."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, begin = np.unique(column[order], return_index=True)
            self.parts.append((values, np.append(begin, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes that differ from ``code`` in at most ``radius`` bits.

        Buckets are probed by listing the masks of a share, or, where fewer buckets hold anything, by comparing those.
        """
        met = np.zeros(len(self.codes), dtype=bool)
        for (values, ends, order), own, share in zip(self.parts, code, shares(radius, len(code))):
            if share < 0:
                continue
            masks = _masks(share, len(values)) if share <= 2 else None
            if masks is None:
                bucket = np.flatnonzero(np.bitwise_count(values ^ own) <= share)
            else:
                bucket = np.searchsorted(values, probes := own ^ masks)
                bucket = bucket[(bucket < len(values)) & (values[np.minimum(bucket, len(values) - 1)] == probes)]
            size = ends[bucket + 1] - ends[bucket]
            first = np.repeat(ends[bucket] - (np.cumsum(size) - size), size)
            met[order[first + np.arange(len(first))]] = True
        place = np.flatnonzero(met)
        return place[np.bitwise_count(self.codes[place] ^ code).sum(axis=1, dtype=np.int64) <= radius]


def _least(vectors: np.ndarray, keep: int) -> np.ndarray:
    """Places, in order, of the first ``keep`` of each set of equal rows: no further copy can be among so many nearest."""
    lines = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    kind = np.unique(lines, return_inverse=True)[1]
    order = np.argsort(kind, kind="stable")
    kinds = kind[order]
    begin = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    rank = np.arange(len(kinds)) - np.repeat(begin, np.diff(np.append(begin, len(kinds))))
    return np.sort(order[rank < keep])


def _top(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's first k, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, query))
    own = query[order]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    return order[rank < k]


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
FOUND = "query_id bigint, vec_id bigint, score double"


def _search(coder: Coder, width: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and queries.num_rows:
            ids, vectors = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"), width)
            order = np.argsort(ids)
            order = order[_least(vectors[order], k + 1)]  # one more, since a query's own row does not count
            ids, vectors = ids[order], unit(vectors[order])
            index = Index(coder.codes(vectors))
            names, asked = queries.column("vec_id").to_numpy(), unit(matrix(queries.column("vector"), width))
            codes, radius = coder.codes(asked), queries.column("radius").to_numpy()
            held: list[tuple[np.ndarray, np.ndarray]] = []
            count = 0
            for i in range(len(names) + 1):
                if held and (i == len(names) or count > _PAIRS):
                    query, place = (np.concatenate(x) for x in zip(*held))
                    score = cosines(vectors[place], asked[query])
                    best = _top(query, ids[place], score, k)
                    out.append(pa.table([names[query[best]], ids[place[best]], score[best]], schema=_FOUND))
                    held, count = [], 0
                if i < len(names):
                    place = index.within(codes[i], int(radius[i]))
                    place = place[ids[place] != names[i]]
                    for s in range(0, len(place), _PAIRS):
                        held.append((np.full(len(place[s : s + _PAIRS]), i), place[s : s + _PAIRS]))
                    count += len(place)
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def _exact(names: np.ndarray, asked: np.ndarray, width: int, k: int):
    """The true nearest rows of a few queries in every batch of rows."""

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(), unit(matrix(batch.column("vector"), width))
            for s in range(0, len(ids), 1024):
                part, own = vectors[s : s + 1024], ids[s : s + 1024]
                query, place = np.nonzero(names[:, None] != own[None, :])
                rough = (Coder._direction(asked) @ Coder._direction(part).T)[query, place]
                best = _top(query, own[place], rough, k)
                query, place = query[best], place[best]
                yield pa.RecordBatch.from_arrays([pa.array(names[query]), pa.array(own[place]), pa.array(cosines(part[place], asked[query]))], schema=_FOUND)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _sample(table: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows by a hash of their id, never more than that; all, if they are fewer."""
    share = min(1.0, 1.1 * most / max(n, 1))
    return table.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(most)


def _vectors(table: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    local = table.select("vec_id", "vector").toArrow().sort_by("vec_id")
    return local.column("vec_id").to_numpy(), unit(matrix(local.column("vector"), width))


def fit_radius(table: DataFrame, coder: Coder, pilots: tuple[np.ndarray, np.ndarray], width: int, k: int, caught: float) -> int:
    """The radius that holds the share ``caught`` of the true nearest rows of the pilots among all rows."""
    names, asked = pilots
    near = _ranked(table.mapInArrow(_exact(names, asked, width, k), FOUND), k).join(table, "vec_id").select("query_id", "vector").toArrow()
    if not near.num_rows:
        return 0
    found = coder.codes(unit(matrix(near.column("vector"), width)))
    codes = coder.codes(asked)[np.searchsorted(names, near.column("query_id").to_numpy())]
    return int(np.quantile(np.bitwise_count(found ^ codes).sum(axis=1), caught, method="higher"))


def nearest(rows: DataFrame, queries: Column, k: int = K, bits: int = BITS, caught: float = CAUGHT) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, its ``k`` nearest found, by cosine.

    ``rows``: vec_id bigint, vector array of numbers; more is ignored. Candidates are all rows but the query's own; ties go to
    the smaller vec_id; all candidates are returned if they are fewer than k. What is found has its exact score; about the
    share ``caught`` of the true neighbours is found. Equal runs give equal results under any partitioning.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null id, take no part. Of rows that
    share a vec_id the one with the least vector counts. Vectors of fewer components than others end in zeros.
    """
    if bits % _SUB:
        raise ValueError(f"codes are cut into substrings of {_SUB} bits")
    given = rows.select("vec_id", F.when(finite(F.col("vector")), F.col("vector")).alias("vector")).dropna()
    table = cut_lineage(one_per_id(given.where(F.exists("vector", lambda x: x != 0)), "vector"))
    n, asked, width = table.agg(F.count("*"), F.count(F.when(queries, 1)), F.max(F.size("vector"))).first()
    width = width or 1
    coder = Coder(_vectors(_sample(table, n, FIT_ROWS), width)[1], bits)
    pilots = _vectors(_sample(table.where(queries), asked, PILOTS), width)
    radius = fit_radius(table, coder, pilots, width, k, caught)
    open_queries = table.where(queries).withColumn("radius", F.lit(radius))
    parts: list[DataFrame] = []
    while asked:
        found = cut_lineage(_ranked(grid(table, open_queries, (n, asked), _search(coder, width, k), FOUND), k))
        full = found.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
        parts.append(found if radius >= bits else found.join(full, found["query_id"] == full["vec_id"], "left_semi"))
        if radius >= bits:
            break
        radius = min(bits, 2 * radius + 4)
        open_queries = cut_lineage(open_queries.join(full, "vec_id", "left_anti").withColumn("radius", F.lit(radius)))
        asked = open_queries.count()
    every = parts[0] if parts else rows.sparkSession.createDataFrame([], FOUND + ", rank int")
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select("query_id", "rank", "vec_id", "score")
