"""Hard-negative mining with exact inner products by the method of Four Russians.

Components are whole numbers. A row is stored as bit planes: of every plane, the bits of eight components are one byte. For
an anchor, a table of 256 entries per eight components holds the sums of all subsets of them, so the byte of a plane is an
index to its share of the inner product; the planes are added from the highest (which counts negative) to the lowest, doubling
in between. No product is formed and no bound is needed: all scores are exact and full.

Anchors meet all rows in a grid of cells. A first pass finds each anchor's positives among the rows of its label, a second one
the negatives, whose scores must lie in the window that a positive sets. A cell hands on the best few of each anchor only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrata.llm.vectors import grid, matrix, one_per_id
from quadrata.session import cut_lineage

POSITIVES, NEGATIVES, LOW = 5, 5, 80
_ANCHORS, _ROWS = 128, 512  # scored at once, so that tables and scores stay in a core's cache
_HITS = 1 << 18
_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Two's complement planes, lowest first, as bytes of eight components: (rows, planes, bytes)."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpack(packed: np.ndarray) -> np.ndarray:
    """The components of packed rows, filled up with zeros to a multiple of eight."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weight = 1 << np.arange(bits.shape[1])
    weight[-1] = -weight[-1]
    return (bits * weight[None, :, None]).sum(axis=1)


class Tables:
    """Subset sums of a few anchors: one table of 256 rows for every eight components, a column per anchor."""

    def __init__(self, anchors: np.ndarray, bound: int):
        kind = np.int32 if bound < 1 << 30 else np.int64
        eights = anchors.reshape(len(anchors), -1, 8)
        self.sums = np.stack([_BITS @ eights[:, g].T for g in range(eights.shape[1])]).astype(kind)

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """Inner products of packed rows with the anchors: (rows, anchors)."""
        shape = (len(packed), self.sums.shape[2])
        total, part = np.zeros(shape, dtype=self.sums.dtype), np.empty(shape, dtype=self.sums.dtype)
        for plane in range(packed.shape[1] - 1, -1, -1):
            total += total
            for g, sums in enumerate(self.sums):
                np.take(sums, packed[:, plane, g], axis=0, out=part, mode="clip")
                if plane == packed.shape[1] - 1:
                    total -= part
                else:
                    total += part
        return total


class Best:
    """The first ``most`` rows of every window, higher scores first, then smaller ids.

    A window belongs to an anchor (a place in the chunk) and holds scores from low to high, in hundredths of a score.
    """

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, bound: int):
        self.anchor, self.low, self.high, self.most, self.bound = anchor, low, high, most, bound
        self.hits = [np.zeros((3, 0), dtype=np.int64)]
        self.held = 0

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.hits.append(np.stack([anchor, ids, score.astype(np.int64)]))
        self.held += len(ids)
        if self.held > _HITS:
            window, place, hits = self._first()
            self.hits = [hits[:, np.unique(place)]]
            self.held = self.hits[0].shape[1]

    def _first(self):
        hits = np.concatenate(self.hits, axis=1)
        hits = hits[:, np.lexsort((hits[1], -hits[2], hits[0]))]
        width = 2 * self.bound + 2
        keys = hits[0] * width + (self.bound - hits[2])
        top = np.clip(self.high // 100, -self.bound - 1, self.bound)
        begin = np.searchsorted(keys, self.anchor * width + (self.bound - top))
        place = (begin[:, None] + np.arange(self.most)[None, :]).ravel()
        window = np.repeat(np.arange(len(begin)), self.most)
        inside = place < hits.shape[1]
        window, place = window[inside], place[inside]
        fits = (hits[0, place] == self.anchor[window]) & (100 * hits[2, place] >= self.low[window])
        return window[fits], place[fits], hits

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, id, score)."""
        window, place, hits = self._first()
        return window, hits[1, place], hits[2, place]


def _packed(table: pa.Table, planes: int, eights: int) -> np.ndarray:
    joined = b"".join(table.column("planes").to_pylist())
    return np.frombuffer(joined, dtype=np.uint8).reshape(table.num_rows, planes, eights)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _positives(planes: int, eights: int, bound: int, most: int):
    schema = pa.schema([(name, pa.int64()) for name in ("anchor_id", "vec_id", "score")])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """Each anchor's best rows of its own label in this cell."""
        out = [np.zeros((3, 0), dtype=np.int64)]
        if rows.num_rows and anchors.num_rows:
            kinds, owns = _numbers(rows, "label"), _numbers(anchors, "label")
            ids, names = _numbers(rows, "vec_id"), _numbers(anchors, "vec_id")
            packed, values = _packed(rows, planes, eights), unpack(_packed(anchors, planes, eights))
            for kind in np.intersect1d(kinds, owns):
                mine, asks = np.flatnonzero(kinds == kind), np.flatnonzero(owns == kind)
                for s in range(0, len(asks), _ANCHORS):
                    asked = asks[s : s + _ANCHORS]
                    tables = Tables(values[asked], bound)
                    every = np.arange(len(asked))
                    best = Best(every, np.full(len(asked), -100 * bound), np.full(len(asked), 100 * bound), most, bound)
                    for t in range(0, len(mine), _ROWS):
                        own = mine[t : t + _ROWS]
                        row, ask = np.nonzero(ids[own][:, None] != names[asked][None, :])
                        best.add(ask, ids[own[row]], tables.scores(packed[own])[row, ask])
                    window, found, score = best.result()
                    out.append(np.stack([names[asked[window]], found, score]))
        return pa.table(list(np.concatenate(out, axis=1)), schema=schema)

    return run


def _negatives(planes: int, eights: int, bound: int, most: int, low: int):
    schema = pa.schema([(name, pa.int64()) for name in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """For each anchor and positive the best rows of another label within the window, in this cell."""
        out = [np.zeros((5, 0), dtype=np.int64)]
        if rows.num_rows and anchors.num_rows:
            kinds, owns = _numbers(rows, "label"), _numbers(anchors, "label")
            ids, names = _numbers(rows, "vec_id"), _numbers(anchors, "vec_id")
            packed, values = _packed(rows, planes, eights), unpack(_packed(anchors, planes, eights))
            lists = anchors.column("positives").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(size)), size)
            ends = np.append(0, np.cumsum(size))
            scores, others = (lists.flatten().field(name).to_numpy() for name in ("score", "vec_id"))
            for s in range(0, len(names), _ANCHORS):
                asked = np.arange(s, min(s + _ANCHORS, len(names)))
                mine = slice(ends[s], ends[asked[-1] + 1])
                asks, score = owner[mine] - s, scores[mine]
                best = Best(asks, low * score, 100 * score, most, bound)
                least = np.full(len(asked), 100 * bound + 1)
                np.minimum.at(least, asks, low * score)
                highest = np.full(len(asked), -bound - 1)
                np.maximum.at(highest, asks, score)
                tables = Tables(values[asked], bound)
                least = -(-least // 100)
                for t in range(0, len(ids), _ROWS):
                    part = slice(t, t + _ROWS)
                    got = tables.scores(packed[part])
                    row, ask = np.nonzero((got >= least) & (got <= highest) & (kinds[part][:, None] != owns[asked][None, :]))
                    best.add(ask, ids[part][row], got[row, ask])
                window, found, got = best.result()
                out.append(np.stack([names[asked[asks[window]]], others[mine][window], score[window], found, got]))
        return pa.table(list(np.concatenate(out, axis=1)), schema=schema)

    return run


def _first(found: DataFrame, keys: list[str], score: str, name: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id bigint, label bigint, vector array<bigint>; more is ignored. A score is the inner product with the
    anchor, higher ones come first, ties by smaller vec_id. The positives of an anchor (a row where ``anchors`` holds) are
    its first other rows of the same label; for each positive, the first rows of other labels whose score is at most the
    positive's and at least ``low`` hundredths of it are its negatives.

    Rows with a null id, label, vector or component take no part. Of rows that share a vec_id the one with the smallest label
    counts, then the one whose bit planes come first. Vectors of fewer components than others end in zeros. Inner products have
    to stay below 2**48, else a ValueError is raised.
    """
    whole = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    given = rows.select("vec_id", "label", F.when(whole, F.col("vector")).alias("vector")).dropna()
    size, most = given.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    eights, largest = -(-(size or 0) // 8) or 1, most or 0
    planes, bound = int(largest).bit_length() + 1, max(1, (size or 0) * largest**2)
    if bound >= 1 << 48:
        raise ValueError("inner products of these vectors may not fit")

    def packed(batches):
        for batch in batches:
            values = matrix(batch.column("vector"), 8 * eights, np.int64)
            lines = pa.array([x.tobytes() for x in pack(values, planes)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lines], ["vec_id", "label", "planes"])

    table = cut_lineage(one_per_id(given.mapInArrow(packed, "vec_id bigint, label bigint, planes binary"), "label", "planes"))
    asked = table.where(anchors)
    counts = table.agg(F.count("*"), F.count(F.when(anchors, 1))).first()
    found = grid(table, asked, tuple(counts), _positives(planes, eights, bound, positives), "anchor_id bigint, vec_id bigint, score bigint")
    best = _first(found, ["anchor_id"], "score", "vec_id", positives)
    lists = cut_lineage(best.groupBy("anchor_id").agg(F.collect_list(F.struct("score", "vec_id")).alias("positives")))
    asked = asked.join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    found = grid(table, asked, tuple(counts), _negatives(planes, eights, bound, negatives, low), schema)
    ranked = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
