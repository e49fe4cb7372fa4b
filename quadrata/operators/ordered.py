"""Global order without a single-task window: running totals, dense keys, ranks, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrata.operators.selection import order_statistics
from quadrata.session import cut_lineage


def running_total(df: DataFrame, order: Sequence[Column], weight: Column | None = None, out: str = "before") -> DataFrame:
    """Sum of ``weight`` over all rows that come earlier in a total order (``weight`` 1 counts rows).

    Rows are range-partitioned by the order and frozen by a checkpoint, since the sampled bounds may differ
    between evaluations. Each partition then adds the total of the earlier partitions to its own running
    sum. The only unpartitioned window runs over one row per partition.
    """
    measure = F.lit(1) if weight is None else weight
    ranged = cut_lineage(
        df.withColumn("_w", measure.cast("bigint"))
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.sum("_w").alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .drop("_part", "_w", "_offset")
    )


def dense_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Surrogate key 1..n in the order of the given columns, nulls last.

    The columns must identify the row; put the natural key first and tie-breakers after it.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order]
    numbered = running_total(df, ordering, out="_before")
    return numbered.select((F.col("_before") + 1).alias(name), *df.columns)


def global_ranks(df: DataFrame, ranks: Mapping[str, str], descending: bool = True) -> DataFrame:
    """Competition ranks over the whole table (ties share the smallest rank), ``{rank column: measure}``.

    All measures are ranked together. Equal values are counted first, so a value held by a third of all rows
    is a single row in the ordering. Missing values come last.
    """
    measures = list(dict.fromkeys(ranks.values()))
    long = df.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], measures, "_measure", "_value")
    counted = long.groupBy("_measure", "_value").agg(F.count(F.lit(1)).alias("_n"))
    value = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_last()
    placed = running_total(counted, [F.col("_measure"), value], F.col("_n"), "_before")
    start = placed.groupBy("_measure").agg(F.min("_before").alias("_start"))
    placed = placed.join(F.broadcast(start), "_measure")  # one row per measure
    for name, measure in ranks.items():
        rank = placed.where(F.col("_measure") == measure).select(
            F.col("_value").alias("_v"), (F.col("_before") - F.col("_start") + 1).alias(name)
        )
        df = df.join(rank, F.col(measure).cast("double").eqNullSafe(F.col("_v")), "left").drop("_v")
    return df


def global_rank(df: DataFrame, by: str, name: str, descending: bool = True) -> DataFrame:
    return global_ranks(df, {name: by}, descending)


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5) -> DataFrame:
    """Exact interpolated quantile of every numeric column: (column_name, n, value), by radix selection.

    A column without values is left out. No value is sorted or shuffled; the driver gets two numbers per column.
    """
    found = order_statistics(df, columns, q)
    rows = []
    for name, (n, low, high) in found.items():
        at = (n - 1) * float(q)
        rows.append((name, n, low if low == high else low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(rows, "column_name string, n bigint, value double")


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """First k rows of an order; Spark keeps k rows per task and merges them."""
    return df.orderBy(*by).limit(k)


def predominant(df: DataFrame, entity: str, category: str, measure: str) -> DataFrame:
    """Category with the largest measure per entity, ties to the smaller name.

    Expects one row per entity and category.
    """
    best = Window.partitionBy(entity).orderBy(F.col(measure).desc(), F.col(category))
    return df.withColumn("_place", F.row_number().over(best)).where("_place = 1").drop("_place")


def change_over_periods(df: DataFrame, entity: str, period: str, measure: str) -> DataFrame:
    """Previous value, absolute and relative change per entity, on rows aggregated to entity and period."""
    previous = F.lag(measure).over(Window.partitionBy(entity).orderBy(period))
    return df.withColumn("previous", previous).withColumns(
        {
            "change": F.col(measure) - F.col("previous"),
            "change_rate": (F.col(measure) - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0)),
        }
    )


def ordered_labels(means: DataFrame, group: str, measure: str, labels: Sequence[str]) -> DataFrame:
    """Rank groups by their mean from 0 and name the ranks; for a handful of groups such as clusters.

    More groups than labels is an error.
    """
    order = F.row_number().over(Window.orderBy(F.col(measure), F.col(group))) - 1
    names = F.array(*[F.lit(label) for label in labels])
    named = F.when(F.col("risk_id") < len(labels), F.get(names, F.col("risk_id")))
    missing = F.raise_error(F.lit(f"more groups than the {len(labels)} labels"))
    few = means.limit(len(labels) + 1)  # enough to tell that there are too many, before any task gathers them
    return few.withColumn("risk_id", order).withColumn("risk_label", F.when(F.col("risk_id") < len(labels), named).otherwise(missing))
