"""Mean silhouettes of several clusterings of the same rows at once.

The squared Euclidean form is linear in the rows. The plain Euclidean one needs the distance of every pair of rows; it is
computed in cells of two stripes of bounded size, so its cost grows with the square of the rows and its memory does not. Equal
rows are one, every pair is met once for all labellings, and up to half a million rows of 64 numbers are dealt to the
same number of cells, so what is shuffled grows with the rows until then. A labelling of many clusters has its small ones,
fewer rows than one in FEW, beside that pass: a row meets its own, and those whose mean distance may be the least by bounds
that follow from the mean and the spread of a cluster.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.operators.kmeans import compact_blocks
from quadrata.session import cut_lineage

#: Rows of a stripe, rows of a group of clusters, clusters up to which a cell sums the distances to each, rows of a block.
STRIPE, GROUP, FEW, BLOCK = 4096, 1 << 15, 32, 64
#: All pairs: rows and numbers of a stripe at most, stripes that keep all cores busy, rows of a tile of distances.
SIDE, VALUES, LEAST, TILE = 1 << 15, 1 << 21, 16, (256, 256)
METRICS = ("euclidean", "squaredEuclidean")


def _squared(df: DataFrame, features: str, label: str) -> float | None:
    shape = df.agg(F.count("*").alias("rows"), F.count_distinct(label).alias("groups")).first()
    if shape["groups"] < 2 or shape["groups"] >= shape["rows"]:
        return None
    shifted = df.withColumn("_cluster", (F.col(label) + 1).cast("int"))
    return ClusteringEvaluator(featuresCol=features, predictionCol="_cluster", metricName="silhouette").evaluate(shifted)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _sums(names: list[list[int]]):
    """For every row of both stripes, the sum of its distances to the rows of each cluster in the other one. A stripe that meets
    itself is told once. Every distance is computed once and counted on both sides, in tiles that stay in a core's cache."""
    schema = pa.schema([("row", pa.int64()), ("sums", pa.list_(pa.float64()))])
    width = sum(map(len, names))

    def members(rows: pa.Table) -> np.ndarray:
        labels = _matrix(rows.column("labels"))
        own = np.concatenate([labels[:, [i]] == np.array(each)[None, :] for i, each in enumerate(names)], axis=1)
        return own * rows.column("n").to_numpy().astype(float)[:, None]

    def told(rows: pa.Table, sums: np.ndarray) -> pa.Table:
        lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, width, dtype=np.int32), sums.ravel())
        return pa.table([rows.column("row").combine_chunks(), lists], schema=schema)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        a, b, itself = _matrix(left.column("x")), _terms(_matrix(right.column("x"))), key[0] == key[1]
        of_a, of_b = members(left), members(right)
        to_b, to_a = np.zeros((left.num_rows, width)), np.zeros((right.num_rows, width))
        for i, j in itertools.product(range(0, left.num_rows, TILE[0]), range(0, right.num_rows, TILE[1])):
            rows, others = slice(i, i + TILE[0]), slice(j, j + TILE[1])
            away = _distances(a[rows], b, others)
            to_b[rows] += away @ of_b[others]
            if not itself:
                to_a[others] += away.T @ of_a[rows]
        return told(left, to_b) if itself else pa.concat_tables([told(left, to_b), told(right, to_a)])

    return run


def _scores(names: list[list[int]], sizes: np.ndarray, many: list[int]):
    """Per labelling the sum of the silhouettes of a task's rows, and how many these are. Equal rows are one with their number.

    ``names``: the large clusters of each labelling, whose sums stand in ``sums``. What the other clusters of the labellings
    ``many`` add stands in ``own``, ``size`` and ``other``.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, sums, times = _matrix(batch.column("labels")), _matrix(batch.column("sums")), batch.column("n").to_numpy()
            small = {c: _matrix(batch.column(c)) for c in ("own", "size", "other")}
            first = 0
            for i, large in enumerate(names):
                n, mine = sizes[first : first + len(large)], sums[:, first : first + len(large)]
                first += len(large)
                j = many.index(i) if i in many else None
                within, size, other = (np.full(len(mine), fill) if j is None else small[c][:, j].copy() for c, fill in (("own", np.nan), ("size", np.nan), ("other", np.inf)))
                other[np.isnan(other)] = np.inf
                at = np.minimum(np.searchsorted(large, labels[:, i]), max(len(large) - 1, 0))
                here = np.flatnonzero(np.array(large)[at] == labels[:, i]) if large else np.zeros(0, int)
                within[here], size[here] = mine[here, at[here]], n[at[here]]
                means = mine / n
                means[here, at[here]] = np.inf
                other = np.minimum(other, means.min(axis=1, initial=np.inf))
                within = within / np.maximum(size - 1, 1)
                larger = np.maximum(within, other)
                score = np.where((size > 1) & (larger > 0) & np.isfinite(larger), (other - within) / np.where(larger > 0, larger, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([(score * times).sum()]), pa.array([times.sum()])], ["i", "s", "n"])

    return run


def _terms(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, the right factor of a product that gives squared distances from them, and below what a square is inexact."""
    squares = (b**2).sum(axis=1)
    return b, np.concatenate([b.T, np.ones((1, len(b))), squares[None, :]]), 1e-6 * (squares + 1)


def _distances(part: np.ndarray, terms: tuple[np.ndarray, np.ndarray, np.ndarray], of: slice = slice(None)) -> np.ndarray:
    b, factor, inexact = terms[0][of], terms[1][:, of], terms[2][of]
    rough = np.concatenate([-2 * part, (part**2).sum(axis=1)[:, None], np.ones((len(part), 1))], axis=1) @ factor
    if rough.min() < inexact.max():
        near = np.argwhere(rough < inexact[None, :])  # what cancels is computed by differences
        for own, other in (near[i : i + (1 << 14)].T for i in range(0, len(near), 1 << 14)):
            rough[own, other] = ((part[own] - b[other]) ** 2).sum(axis=1)
    return np.sqrt(rough, out=rough)


def _at(centres: np.ndarray):
    """Rows with the nearest centre, their stripe, and how far away it is."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, own, away = _matrix(batch.column("x")), [], []
                for i in range(0, len(x), step := max(1, (1 << 20) // len(centres))):
                    apart = _distances(x[i : i + step], _terms(centres))
                    own.append(apart.argmin(axis=1))
                    away.append(np.sqrt(((x[i : i + step] - centres[own[-1]]) ** 2).sum(axis=1)))
                columns = [pa.array(np.concatenate(own), pa.int32()), pa.array(np.concatenate(away))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "stripe", "away"])

    return run


class _Clusters:
    """The clusters of a table of (label, x, n): where each begins, its size, mean and root mean square distance from it."""

    def __init__(self, rows: pa.Table) -> None:
        self.rows = rows = rows.sort_by("label")
        self.x, self.n = _matrix(rows.column("x")), rows.column("n").to_numpy().astype(float)
        self.names, self.begins, self.at = np.unique(rows.column("label").to_numpy(), return_index=True, return_inverse=True)
        self.sizes = np.add.reduceat(self.n, self.begins)
        self.means = np.add.reduceat(self.x * self.n[:, None], self.begins, axis=0) / self.sizes[:, None]
        self.spread = np.sqrt(np.add.reduceat(((self.x - self.means[self.at]) ** 2).sum(axis=1) * self.n, self.begins) / self.sizes)

    def beside(self, centre: np.ndarray, radius: float) -> np.ndarray:
        """Which clusters may have the least mean distance of those that are not a row's own, for rows of a ball.

        The mean distance from a point to a cluster is no less than the distance d to its mean, and no more than
        sqrt(d^2 + spread^2). One of the two lowest upper bounds is that of another cluster than the row's own.
        """
        d = np.sqrt(((self.means - centre) ** 2).sum(axis=1))
        if len(d) < 3:
            return np.ones(len(d), dtype=bool)
        bound = np.partition(np.hypot(d + radius, self.spread), 1)[1]
        return d - radius <= bound + 1e-9 * (d + radius + np.abs(centre).max() + 1)


def _wanted(centres: np.ndarray, radii: np.ndarray):
    """The stripes to which each cluster has to go: those of its rows, and those that it may be beside."""
    schema = pa.schema([("i", pa.int32()), ("label", pa.int32()), ("stripe", pa.int32())])

    def run(key, rows):
        clusters = _Clusters(rows)
        its = clusters.rows.column("stripe").to_numpy()
        out = []
        for stripe, (centre, radius) in enumerate(zip(centres, radii)):
            go = clusters.beside(centre, radius)
            go[clusters.at[its == stripe]] = True
            out.append(clusters.names[go])
        stripes = np.repeat(np.arange(len(centres)), [len(x) for x in out])
        return pa.table([pa.array(np.full(len(stripes), key[0].as_py()), pa.int32()), pa.array(np.concatenate(out), pa.int32()), pa.array(stripes, pa.int32())], schema=schema)

    return run


_FOUND = pa.schema([("row", pa.int64()), ("i", pa.int32()), ("own", pa.float64()), ("size", pa.float64()), ("other", pa.float64())])


def _grouped(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """For every row of a stripe: the sum of its distances to its own cluster, if that is here, and its size, and the least mean of
    another one. Rows are taken in compact blocks, which only meet the clusters that may be beside them."""
    if not left.num_rows or not right.num_rows:
        return _FOUND.empty_table()
    a, mine, clusters = _matrix(left.column("x")), left.column("label").to_numpy(), _Clusters(right)
    own, size, other = np.full(len(a), np.nan), np.full(len(a), np.nan), np.full(len(a), np.inf)
    place = np.minimum(np.searchsorted(clusters.names, mine), len(clusters.names) - 1)
    present = clusters.names[place] == mine
    for block in compact_blocks(a, BLOCK):
        centre = a[block].mean(axis=0)
        meet = clusters.beside(centre, np.sqrt(((a[block] - centre) ** 2).sum(axis=1).max()))
        meet[place[block[present[block]]]] = True
        members = np.flatnonzero(meet[clusters.at])
        kept = np.flatnonzero(meet)
        terms, begins = _terms(clusters.x[members]), np.searchsorted(clusters.at[members], kept)
        for rows in np.split(block, range(step := max(1, (1 << 21) // len(members)), len(block), step)):
            sums = np.add.reduceat(_distances(a[rows], terms) * clusters.n[members], begins, axis=1)
            means = sums / clusters.sizes[kept]
            here = np.flatnonzero(present[rows])
            at = np.searchsorted(kept, place[rows[here]])
            own[rows[here]], size[rows[here]] = sums[here, at], clusters.sizes[kept[at]]
            means[here, at] = np.inf
            other[rows] = means.min(axis=1)
    i = pa.array(np.full(len(a), key[1].as_py()), pa.int32())
    return pa.table([left.column("row"), i, *(pa.array(v, mask=~np.isfinite(v)) for v in (own, size, other))], schema=_FOUND)


def _stripes(alike: DataFrame, total: int, wanted: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows with their stripe, one of about ``wanted`` compact ones, and the centres and radii of the stripes.

    The centres are drawn on some 16,384 rows by a hash; every row goes to the nearest one.
    """
    drawn = alike.where(F.pmod(F.xxhash64("row"), F.lit(max(1, total >> 14))) == 0).select("x").collect()
    drawn = np.array([r.x for r in drawn or alike.select("x").head(1)])
    centres = np.array([drawn[part].mean(axis=0) for part in compact_blocks(drawn, math.ceil(len(drawn) / wanted))])
    kinds = ", ".join(f"{c} {t}" for c, t in alike.dtypes)
    placed = cut_lineage(alike.mapInArrow(_at(centres), f"{kinds}, stripe int, away double"))
    radii = np.zeros(len(centres))
    for r in placed.groupBy("stripe").agg(F.max("away").alias("radius")).collect():  # one row per stripe
        radii[r.stripe] = r.radius
    return placed, centres, radii


def _beside(alike: DataFrame, many: list[int], names: list[list[int]], shape: tuple[int, int]) -> DataFrame:
    """(row, own, size, other): per labelling of ``many`` what the clusters that are not in ``names`` say of a row."""
    placed, centres, radii = _stripes(alike, *shape)
    told = placed.select("row", "x", "n", "stripe", F.posexplode("labels").alias("i", "label")).where(F.col("i").isin(many))
    large = [(F.col("i") == i) & F.col("label").isin(names[i]) for i in many if names[i]]
    small = told.where(~reduce(Column.__or__, large)) if large else told
    part = F.pmod(F.xxhash64("label"), F.lit(max(1, math.ceil(2 * shape[0] / GROUP)))).cast("int")
    pairs = small.withColumn("part", part).groupBy("i", "part").applyInArrow(_wanted(centres, radii), "i int, label int, stripe int")
    sent = cut_lineage(small.select("i", "label", "x", "n").join(pairs, ["i", "label"]))
    cells = sent.groupBy("stripe", "i").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    cells = F.broadcast(cut_lineage(cells))  # one row per stripe and labelling
    right = sent.join(cells, ["stripe", "i"]).withColumn("part", F.pmod(F.xxhash64("label"), "parts")).drop("parts")
    left = told.select("row", "x", "stripe", "i", "label").join(cells, ["stripe", "i"])
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # a checkpoint keeps the identities of its columns
    keys = ["stripe", "i", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_grouped, "row bigint, i int, own double, size double, other double")
    each = [[F.when(F.col("i") == i, F.col(c)) for i in many] for c in ("own", "size", "other")]
    return found.groupBy("row").agg(
        F.array(*map(F.max, each[0])).alias("own"), F.array(*map(F.max, each[1])).alias("size"), F.array(*map(F.min, each[2])).alias("other")
    )


def _euclidean(df: DataFrame, features: str, labels: Sequence[str]) -> list[float | None]:
    rows = df.select(F.monotonically_increasing_id().alias("row"), vector_to_array(features).alias("x"), F.array(*[F.col(c).cast("int") for c in labels]).alias("labels"))
    rows = cut_lineage(rows)
    total = rows.count()
    if not total:
        return [None] * len(labels)
    told = rows.agg(*[F.count_distinct(F.get("labels", F.lit(i))).alias(f"d{i}") for i in range(len(labels))]).first()
    scored = [i for i in range(len(labels)) if 2 <= told[i] < total]
    if not scored:
        return [None] * len(labels)
    kept = rows.withColumn("labels", F.array(*[F.get("labels", F.lit(i)) for i in scored]))
    scores = dict(zip(scored, _by_rows(kept, [told[i] for i in scored], total), strict=True))
    return [scores.get(i) for i in range(len(labels))]


def _by_rows(rows: DataFrame, clusters: list[int], total: int) -> list[float]:
    """The mean silhouettes of labellings of so many ``clusters``.

    The distances of a row to all rows of a large cluster come from one pass over all pairs of rows, for all labellings. Where there
    are too many clusters for that, the small ones are met only by the rows that they may be beside, and by their own.
    """
    many = [i for i, n in enumerate(clusters) if n > FEW]
    counted = rows.select(F.posexplode("labels").alias("i", "label")).groupBy("i", "label").count()
    counted = counted.where((~F.col("i").isin(many)) | (F.col("count") * FEW >= total)).orderBy("i", "label").collect()  # FEW rows per labelling
    names = [[r.label for r in counted if r.i == i] for i in range(len(clusters))]
    sizes = np.array([r["count"] for r in counted], dtype=float)
    alike = rows.groupBy("x", "labels").agg(F.count("*").alias("n"))
    alike = cut_lineage(alike.select(F.monotonically_increasing_id().alias("row"), "x", "labels", "n"))
    shape = alike.agg(F.count("*").alias("rows"), F.max(F.size("x")).alias("width")).first()
    least = min(LEAST, math.ceil(shape["rows"] / TILE[0]))
    told = alike
    if counted:
        side = max(1, min(SIDE, VALUES // max(shape["width"], 1)))
        stripes = max(math.ceil(shape["rows"] / side), least)
        dealt = alike.withColumn("own", F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int"))
        left = dealt.withColumns({"a": F.col("own"), "b": F.explode(F.sequence("own", F.lit(stripes - 1)))}).drop("own")
        right = dealt.withColumns({"a": F.explode(F.sequence(F.lit(0), "own")), "b": F.col("own")}).drop("own")
        parts = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_sums(names), "row bigint, sums array<double>")
        told = told.join(parts.groupBy("row").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")), "row")
    else:
        told = told.withColumn("sums", F.array().cast("array<double>"))
    if many:
        told = told.join(_beside(alike, many, names, (shape["rows"], max(math.ceil(shape["rows"] / STRIPE), least))), "row")
    else:
        told = told.withColumns({c: F.array().cast("array<double>") for c in ("own", "size", "other")})
    parts = told.select("labels", "sums", "n", "own", "size", "other").mapInArrow(_scores(names, sizes, many), "i int, s double, n bigint")
    found = {r.i: r.s / r.n for r in parts.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}  # one row per labelling
    return [found[i] for i in range(len(clusters))]


def silhouettes(df: DataFrame, labels: Sequence[str], features: str = "features", metric: str = "euclidean") -> list[float | None]:
    """Mean silhouette of each label column (whole numbers, not null; noise, -1, counts as a cluster of its own).

    None for fewer than two clusters or as many as rows. A row alone in its cluster scores 0.
    """
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    if metric == "euclidean":
        return _euclidean(df, features, labels)
    return [_squared(df, features, c) for c in labels]
