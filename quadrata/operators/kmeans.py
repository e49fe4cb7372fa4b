"""k-means for all cluster counts and all starts at once: exact Lloyd iterations over compact blocks of rows.

Rows are cut once, inside their partitions, into blocks of neighbouring rows, each kept with its centre, radius, sum and sum of
squares. One scan of the blocks moves the centres of every open fit. By the triangle inequality a centre can be the nearest
of some row of a block only if its distance from the block's centre exceeds the smallest such distance by two radii at most; a
fit for which one centre is left takes the whole block by its sums, and only the centres left are compared with rows. Fits
that no longer move are left out of the next scan. The driver holds the centres, never rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.session import cut_lineage

#: Rows that are cut into blocks together, rows of a block, and rows that starts are chosen among.
CHUNK, LEAF, START_ROWS = 1 << 16, 256, 4096
_BLOCK = "n bigint, width int, points binary, centre binary, radius double, squares double"


@dataclass
class Fit:
    """One run: its centres (k rows), the sum of squared distances to them, and how many scans moved it."""

    k: int
    seed: int
    centres: np.ndarray
    inertia: float = float("nan")
    iterations: int = 0
    moving: bool = field(default=True, repr=False)

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with the number of each row's nearest centre; null without a vector."""
        return df.withColumn(out, F.when(F.col(features).isNotNull(), nearest_centre(as_array(features), self.centres)))


def compact_blocks(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Places of the rows of each block: halved at the median of the widest coordinate until small or all equal."""
    done, open_parts = [], [np.arange(len(points))]
    while open_parts:
        part = open_parts.pop()
        own = points[part]
        spread = own.max(axis=0) - own.min(axis=0)
        if len(part) <= leaf or not spread.max() > 0:
            done.append(part)
            continue
        order = np.argpartition(own[:, int(spread.argmax())], len(part) // 2)
        open_parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return done


def _cut(batches):
    schema = pa.schema([("n", pa.int64()), ("width", pa.int32()), *((c, pa.binary()) for c in ("points", "centre")), ("radius", pa.float64()), ("squares", pa.float64())])

    def cut(lists: list[pa.Array]) -> pa.RecordBatch:
        values = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])
        points = values.reshape(sum(map(len, lists)), -1)
        rows = []
        for part in compact_blocks(points):
            own = points[part]
            centre = own.mean(axis=0)
            apart = ((own - centre) ** 2).sum(axis=1)
            rows.append((len(own), own.shape[1], own.tobytes(), centre.tobytes(), float(np.sqrt(apart.max())), float(apart.sum())))
        return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)

    held: list[pa.Array] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0))
        if sum(map(len, held)) >= CHUNK:
            yield cut(held)
            held = []
    if held:
        yield cut(held)


def as_array(features: str) -> Column:
    """A vector column as an array, an empty one for null, on which Spark's own function fails wherever it is evaluated."""
    return vector_to_array(F.coalesce(F.col(features), array_to_vector(F.array().cast("array<double>"))))


def row_blocks(vectors: DataFrame, features: str = "features") -> DataFrame:
    """The rows as blocks, written once. Null vectors take no part."""
    arrays = vectors.where(F.col(features).isNotNull()).select(as_array(features).alias("x"))
    return cut_lineage(arrays.mapInArrow(_cut, _BLOCK))


def _scan(fits: list[Fit]):
    """Per centre of all fits: rows, sum of rows and sum of squared distances, folded within each task."""
    centres = np.concatenate([f.centres for f in fits])
    norms = (centres**2).sum(axis=1)
    ends = np.cumsum([f.k for f in fits])
    begins = ends - [f.k for f in fits]
    groups = {k: begins[[i for i, f in enumerate(fits) if f.k == k]] for k in {f.k for f in fits}}

    def run(batches):
        n, cost, sums = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres)), np.zeros(centres.shape)
        for batch in batches:
            for size, width, points, centre, radius, squares in zip(*(c.to_pylist() for c in batch.columns)):
                middle = np.frombuffer(centre)
                offset = ((centres - middle) ** 2).sum(axis=1)
                away = np.sqrt(offset)
                least = np.repeat(np.minimum.reduceat(away, begins), ends - begins)
                alive = away <= least + 2 * radius + 1e-9 * (1 + least)
                whole = np.repeat(np.add.reduceat(alive.astype(np.int64), begins) == 1, ends - begins)
                sure = np.flatnonzero(alive & whole)
                n[sure] += size
                sums[sure] += size * middle
                cost[sure] += squares + size * offset[sure]
                some = np.flatnonzero(alive & ~whole)
                if not len(some):
                    continue
                own = np.frombuffer(points).reshape(size, width)
                apart = np.full((size, len(centres)), np.inf)
                apart[:, some] = norms[some] - 2 * (own @ centres[some].T)
                mine = np.zeros((size, len(centres)))
                for k, first in groups.items():
                    first = first[~whole[first]]
                    if len(first):
                        near = first[None, :] + apart[:, first[:, None] + np.arange(k)[None, :]].argmin(axis=2)
                        mine[np.arange(size)[:, None], near] = 1.0
                own_squares = (own**2).sum(axis=1)
                n[some] += mine[:, some].sum(axis=0).astype(np.int64)
                sums[some] += mine[:, some].T @ own
                cost[some] += (mine[:, some] * np.maximum(apart[:, some] + own_squares[:, None], 0.0)).sum(axis=0)
        used = np.flatnonzero(n)
        lists = pa.array(sums[used].tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(cost[used]), lists], ["centre", "n", "cost", "sums"])

    return run


def _moments(blocks: DataFrame, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, cost, sums) per centre over all blocks: one job, one row per centre and task before the shuffle."""
    total, width = sum(f.k for f in fits), fits[0].centres.shape[1]
    parts = blocks.mapInArrow(_scan(fits), "centre bigint, n bigint, cost double, sums array<double>")
    folded = parts.groupBy("centre").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("sums")).alias("sums"))
    n, cost, sums = np.zeros(total), np.zeros(total), np.zeros((total, width))
    for row in folded.collect():  # one row per centre
        n[row.centre], cost[row.centre], sums[row.centre] = row.n, row.cost, row.sums.toArray()
    return n, cost, sums


def starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of the sample, each drawn by its squared distance to those before (k-means++)."""
    rng = np.random.default_rng([seed, k])
    chosen = [int(rng.integers(len(sample)))]
    apart = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        weight = apart / apart.sum() if apart.sum() > 0 else None
        chosen.append(int(rng.choice(len(sample), p=weight)))
        apart = np.minimum(apart, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen].copy()


def start_sample(vectors: DataFrame, n: int, features: str = "features", rows: int = START_ROWS) -> np.ndarray:
    """Different vectors, at most ``rows`` of them, by a hash of the vector; all if there are fewer. In an order of their own."""
    array = as_array(features)
    some = vectors.where(F.col(features).isNotNull()).select(array.alias("x")).where(
        F.pmod(F.xxhash64("x"), F.lit(1 << 30)) < int(min(1.0, 1.2 * rows / max(n, 1)) * (1 << 30))
    )
    found = np.array([r.x for r in some.distinct().limit(rows).collect()], dtype=float)
    return found[np.lexsort(found.T[::-1])] if len(found) else found


def lloyd(blocks: DataFrame, fits: list[Fit], iterations: int | None = 300, tolerance: float = 1e-6, idle: int = 10) -> list[Fit]:
    """Moves all fits until none moves a centre by more than ``tolerance``; every fit ends with the cost of its centres.

    At most ``iterations`` + 1 scans. A centre without rows stays where it is. None sets no bound: every move lowers the cost,
    so no clustering comes twice; where rounding alone moves centres, a fit ends after ``idle`` scans without a lower cost.
    """
    least, waited = [float("inf")] * len(fits), [0] * len(fits)
    for turn in itertools.count():
        moving = [i for i, f in enumerate(fits) if f.moving]
        if not moving:
            return fits
        n, cost, sums = _moments(blocks, [fits[i] for i in moving])
        first = 0
        for i in moving:
            f = fits[i]
            own = slice(first, first := first + f.k)
            f.inertia = float(cost[own].sum())
            least[i], waited[i] = (f.inertia, 0) if f.inertia < least[i] else (least[i], waited[i] + 1)
            filled = n[own] > 0
            moved = f.centres.copy()
            moved[filled] = sums[own][filled] / n[own][filled][:, None]
            shift = float(np.sqrt(((moved - f.centres) ** 2).sum(axis=1)).max())
            f.moving = shift > tolerance and (waited[i] < idle if iterations is None else turn < iterations)
            if f.moving:
                f.centres, f.iterations = moved, f.iterations + 1


def kmeans_fits(
    vectors: DataFrame, ks: Sequence[int], restarts: int = 20, seed: int = 42, features: str = "features", iterations: int = 300, tolerance: float = 1e-6
) -> list[Fit]:
    """A fit for every k and every start, in the order of ks and seeds; ties and equal rows are no special case.

    ``iterations`` and ``tolerance`` end the comparison of the starts. The best fit of every k then moves on until its centres
    are the means of the rows nearest to them, which takes as many scans as it takes and never makes it worse.
    All vectors have the same length. Without a vector the result is empty; with fewer different vectors than k, some
    centres coincide.
    """
    blocks = row_blocks(vectors, features)
    rows = blocks.agg(F.sum("n")).first()[0] or 0
    sample = start_sample(vectors, rows, features) if rows else np.zeros((0, 0))
    if not len(sample):  # a hash may leave out the few different vectors of a table of copies
        sample = start_sample(vectors, 1, features) if rows else sample
    if not len(sample):
        return []
    fits = lloyd(blocks, [Fit(k, seed + i, starts(sample, k, seed + i)) for k in ks for i in range(restarts)], iterations, tolerance)
    best = list(best_fits(fits).values())
    for f in best:
        f.moving = True
    lloyd(blocks, best, None, 1e-12 * (1 + float(np.abs(sample).max())))
    return fits


def best_fits(fits: Sequence[Fit]) -> dict[int, Fit]:
    """Of every k the fit with the lowest inertia, then the smallest seed."""
    best: dict[int, Fit] = {}
    for f in fits:
        if f.k not in best or f.inertia < best[f.k].inertia:
            best[f.k] = f
    return best


def optimality(df: DataFrame, fits: Sequence[Fit], features: str = "features") -> DataFrame:
    """(k, n_rows, n_nearest, centre_gap, total_ss) per fit, recomputed from the rows and their assigned clusters.

    ``n_nearest``: rows whose cluster's mean is the nearest of all means; ``centre_gap``: largest distance of a centre from
    its mean; ``total_ss``: the fit's inertia plus the squares between the means, which is the total sum of squares exactly
    if the centres are means. With several optimal clusters a row counts as nearest at any of them.
    """
    array = as_array(features)
    told = []
    for fit in fits:
        placed = fit.transform(df.where(F.col(features).isNotNull()), features, "_k").select(features, "_k")
        means = {r["_k"]: r for r in placed.groupBy("_k").agg(Summarizer.mean(F.col(features)).alias("m"), F.count("*").alias("n")).collect()}
        centres = np.stack([means[i].m.toArray() if i in means else fit.centres[i] for i in range(fit.k)])
        sizes = np.array([means[i].n if i in means else 0 for i in range(fit.k)], dtype=float)
        away = squared_distances(array, centres)
        own = F.get(F.array(*away), "_k")
        nearest = placed.where(own <= F.least(*away) * (1 + 1e-9)).count()
        overall = (sizes[:, None] * centres).sum(axis=0) / max(sizes.sum(), 1)
        between = float((sizes * ((centres - overall) ** 2).sum(axis=1)).sum())
        gap = float(np.sqrt(((centres - fit.centres) ** 2).sum(axis=1)).max())
        told.append((fit.k, int(sizes.sum()), nearest, gap, fit.inertia + between))
    return df.sparkSession.createDataFrame(told, "k int, n_rows bigint, n_nearest bigint, centre_gap double, total_ss double")


def squared_distances(array: Column, centres: np.ndarray) -> list[Column]:
    """Squared distance of an array column from each centre."""

    def apart(centre: np.ndarray) -> Column:
        other = F.array(*[F.lit(float(x)) for x in centre])
        return F.aggregate(F.zip_with(array, other, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    return [apart(c) for c in centres]


def nearest_centre(array: Column, centres: np.ndarray) -> Column:
    """Number of the centre nearest to an array column, ties to the smaller number."""
    away = squared_distances(array, centres)
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(away)]))["i"]
