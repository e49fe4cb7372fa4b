"""Vector tables: which rows take part, arrays as matrices, and a grid of bounded cells in which a stated query set meets all rows."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRIPE, GROUP, LEAST = 1 << 16, 1 << 13, 1 << 10


def finite(vector: Column) -> Column:
    """True where a vector is given and so is every component, none of them infinite or not a number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def one_per_id(rows: DataFrame, *others: str) -> DataFrame:
    """``vec_id`` and ``others``: of rows that share a vec_id the one with the least others, in their order; null ids go."""
    kept = rows.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min(F.struct(*others)).alias("kept"))
    return kept.select("vec_id", *(F.col(f"kept.{name}").alias(name) for name in others))


def matrix(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Lists of numbers as rows of one matrix; shorter lists end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(lists), width), dtype=kind)
    if len(lists):
        size = np.diff(lists.offsets.to_numpy())
        out[np.arange(width)[None, :] < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def grid(rows: DataFrame, queries: DataFrame, counts: tuple[int, int], run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` over cells of a stripe of ``rows`` and a group of ``queries``, both with different vec_ids, so that each query meets each row once.

    A cell holds about STRIPE rows and GROUP queries at most, however many there are; every row is sent once for each
    group and every query once for each stripe. ``counts``: of rows and of queries.
    """
    wanted = 4 * rows.sparkSession.sparkContext.defaultParallelism
    stripes = max(1, math.ceil(counts[0] / STRIPE), min(wanted, math.ceil(counts[0] / LEAST)))
    groups = max(1, math.ceil(counts[1] / GROUP))
    striped = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(stripes)).cast("int").alias("stripe"))
    grouped = queries.toDF(*queries.columns).select("*", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int").alias("cell"))
    left = striped.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("cell"))
    right = grouped.select("*", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    return left.groupBy("stripe", "cell").cogroup(right.groupBy("stripe", "cell")).applyInArrow(run, schema)
