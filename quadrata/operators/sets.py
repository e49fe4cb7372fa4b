"""Set operators over keys and periods, and null-safe lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_periods(frames: Sequence[DataFrame], period: str, preferred: Sequence[int] = ()) -> DataFrame:
    """The preferred periods if every frame has all of them, else all periods the frames share."""
    shared = reduce(
        lambda a, b: a.join(b, period, "left_semi"), [f.select(period).where(F.col(period).isNotNull()).distinct() for f in frames]
    )
    if not preferred:
        return shared
    wanted = F.col(period).isin(list(preferred))
    complete = shared.where(wanted).agg((F.count(F.lit(1)) == len(set(preferred))).alias("ok")).scalar()
    return shared.where(~complete | wanted)


def require_periods(periods: DataFrame) -> DataFrame:
    """The same frame, or an error if it is empty."""
    if periods.isEmpty():
        raise ValueError("the sources share no period")
    return periods


def missing_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Distinct non-null keys of the left side that the right side lacks.

    Both sides are made distinct first, in the partitioning the join needs anyway, so a key repeated in a
    third of all rows travels once per task.
    """
    right_key = right_key or left_key
    keys = left.select(F.col(left_key).alias("key")).where(F.col("key").isNotNull()).distinct()
    known = right.select(F.col(right_key).alias("key")).distinct()
    return keys.join(known, "key", "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks, rows without a key included."""
    return fact.join(dim.select(F.col(dim_key).alias(fact_key)), fact_key, "left_anti")


def same_set(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: is each side contained in the other, compared as sets."""
    left, right = left.distinct(), right.distinct()
    only_left = left.join(right, left.columns, "left_anti").agg(F.count(F.lit(1)).alias("only_left"))
    only_right = right.join(left, right.columns, "left_anti").agg(F.count(F.lit(1)).alias("only_right"))
    return only_left.select(
        "only_left", only_right.scalar().alias("only_right")
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def lookup_null_safe(
    fact: DataFrame, dim: DataFrame, natural: Sequence[str], surrogate: str
) -> DataFrame:
    """Left join that adds the surrogate key of a composite natural key in which null matches null."""
    renamed = dim.select(*[F.col(c).alias(f"_dim_{c}") for c in natural], surrogate)
    condition = reduce(
        lambda a, b: a & b, [fact[c].eqNullSafe(renamed[f"_dim_{c}"]) for c in natural]
    )
    return fact.join(renamed, condition, "left").drop(*[f"_dim_{c}" for c in natural])
