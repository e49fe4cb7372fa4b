"""Second moments of many columns from one pass over blocks of rows, with a count for every pair of columns that has gaps.

Rows arrive as matrices. For two blocks of columns, five products give the pairs' counts, sums, sums of squares and products
over the rows that have both values; only blocks on and above the diagonal are formed. Values are shifted by their column's
mean first, so little is lost when squares of sums are taken off. What is shuffled is one matrix per task and pair of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = 64
#: A variance below this share of the mean square of the shifted values is what rounding leaves of none.
FLAT = 1e-13
_PARTS = ("n", "a", "b", "aa", "bb", "ab")


def _products(width: int, shift: np.ndarray):
    pairs = [(i, j) for i in range(0, width, SIDE) for j in range(i, width, SIDE)]

    def run(batches):
        sums = {}
        for batch in batches:
            given = np.stack([~c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            values = np.where(given, raw - shift, 0.0)
            mask, squares = given.astype(float), values**2
            for i, j in pairs:
                a, b = slice(i, i + SIDE), slice(j, j + SIDE)
                products = [mask[:, a].T @ mask[:, b], values[:, a].T @ mask[:, b], mask[:, a].T @ values[:, b], squares[:, a].T @ mask[:, b], mask[:, a].T @ squares[:, b], values[:, a].T @ values[:, b]]
                found = np.stack(products)
                sums[i, j] = sums[i, j] + found if (i, j) in sums else found
        lists = pa.array([x.ravel().tolist() for x in sums.values()], pa.list_(pa.float64()))
        places = [pa.array([key[k] for key in sums], pa.int32()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*places, lists], ["i", "j", "sums"])

    return run


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, a, b, aa, bb, ab) for the places i <= j of two columns: sums over the rows that have both, shifted by the means.

    ``a`` belongs to column i, ``b`` to column j. Without rows the result is empty. A task holds six numbers per pair of columns.
    """
    width = len(columns)
    numbers = df.select(*[F.col(f"`{name}`").cast("double").alias(f"v{i}") for i, name in enumerate(columns)])
    means = numbers.agg(*[F.avg(f"v{i}").alias(f"v{i}") for i in range(width)]).first()
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in means])
    parts = numbers.mapInArrow(_products(width, shift), "i int, j int, sums array<double>")
    folded = parts.groupBy("i", "j").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    rows, cols = F.least(F.lit(SIDE), width - F.col("i")), F.least(F.lit(SIDE), width - F.col("j"))
    size = folded.withColumns({"cols": cols, "size": rows * cols})
    each = size.select("i", "j", "cols", "size", "sums", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at"))
    values = [F.get("sums", F.col("at") + F.col("size") * k).alias(name) for k, name in enumerate(_PARTS)]
    placed = each.select((F.col("i") + F.floor(F.col("at") / F.col("cols"))).cast("int").alias("i"), (F.col("j") + F.col("at") % F.col("cols")).cast("int").alias("j"), *values)
    return placed.where("i <= j")


def covariance() -> Column:
    """Population covariance of a row of ``pair_moments``; null without a row that has both values."""
    n = F.nullif(F.col("n"), F.lit(0.0))
    return (F.col("ab") - F.col("a") * F.col("b") / n) / n


def correlation() -> Column:
    """Pearson correlation of a row of ``pair_moments``; null where either column is constant over the rows that have both."""
    n = F.nullif(F.col("n"), F.lit(0.0))
    spread = [F.col(x * 2) - F.col(x) * F.col(x) / n for x in "ab"]
    flat = (spread[0] <= FLAT * F.col("aa")) | (spread[1] <= FLAT * F.col("bb"))
    root = F.sqrt(F.nullif(spread[0], F.lit(0.0))) * F.sqrt(F.nullif(spread[1], F.lit(0.0)))
    return F.when(~flat, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (F.col("ab") - F.col("a") * F.col("b") / n) / root)))


def named(moments: DataFrame, columns: Sequence[str], value: Column, name: str) -> DataFrame:
    """(feature_a, feature_b, value) with the columns' names."""
    names = F.array(*[F.lit(c) for c in columns])
    return moments.select(F.get(names, "i").alias("feature_a"), F.get(names, "j").alias("feature_b"), value.alias(name))
