"""OLAP operations on a fact with its attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.operators.ordered import global_ranks


def cut(df: DataFrame, fixed: Mapping[str, object]) -> DataFrame:
    """Slice (one fixed member) or dice (several); a list fixes a set of members, a pair tuple a range."""

    def test(name: str, value) -> Column:
        if isinstance(value, tuple):
            return F.col(name).between(*value)
        return F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value

    return df.where(reduce(lambda a, b: a & b, [test(n, v) for n, v in fixed.items()]))


def rollup(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Subtotals along a hierarchy, with the grouping id that tells the level."""
    return df.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_id"), *[m.alias(n) for n, m in measures.items()]
    )


def cube(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Subtotals for every subset of the levels."""
    return df.cube(*levels).agg(
        F.grouping_id().cast("int").alias("level_id"), *[m.alias(n) for n, m in measures.items()]
    )


def drill_down(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The same fact at a finer grain."""
    return df.groupBy(*levels).agg(*[m.alias(n) for n, m in measures.items()])


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Inner joins of a fact with its dimensions, each on the key column it shares with the fact."""
    return reduce(lambda df, item: df.join(item[1], item[0]), dims.items(), fact)


def above_average(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows that lie above the mean of each measure at the same time."""
    means = df.agg(F.struct(*[F.avg(m).alias(m) for m in measures]).alias("m")).scalar()
    return df.where(reduce(lambda a, b: a & b, [F.col(m) > means[m] for m in measures]))


def composite_rank(df: DataFrame, measures: Sequence[str], name: str = "activity_rank") -> DataFrame:
    """Rank by the sum of the descending ranks of several measures."""
    ranked = global_ranks(df, {f"rank_{m}": m for m in measures})
    scored = ranked.withColumn("rank_sum", reduce(lambda a, b: a + b, [F.col(f"rank_{m}") for m in measures]))
    return global_ranks(scored, {name: "rank_sum"}, descending=False)
