"""Grouped aggregates: counts, weighted means, snapshot roll-ups, fixed-list pivots, column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.functions.numeric import safe_ratio


def zero_sum(col: Column | str) -> Column:
    """Sum that is 0 for an all-null group."""
    return F.coalesce(F.sum(col), F.lit(0))


def counts_with_complement(
    df: DataFrame, keys: Sequence[str], total: str, flagged: str, complement: str, share: str, n=None, flag="flag"
) -> DataFrame:
    """Rows, flagged rows, their difference and share per group.

    ``n`` names a column of row counts when the input is already folded; else every row counts once.
    """
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total) if n is None else F.sum(n).alias(total),
        F.sum(flag).cast("bigint").alias(flagged),
    )
    return grouped.select(
        *keys,
        total,
        flagged,
        (F.col(total) - F.col(flagged)).alias(complement),
        safe_ratio(flagged, total).alias(share),
    )


def weighted_parts(values: Mapping[str, Column | str], weight: Column | str) -> dict[str, Column]:
    """Per-row terms whose sums give the weighted means: value * weight, and the weight where both exist."""
    w = F.col(weight) if isinstance(weight, str) else weight
    parts = {}
    for name, value in values.items():
        v = F.col(value) if isinstance(value, str) else value
        parts[f"{name}__num"] = v * w
        parts[f"{name}__den"] = F.when(v.isNotNull(), w)
    return parts


def weighted_from_parts(names: Sequence[str], suffix: str = "_wmean") -> list[Column]:
    """Weighted means out of summed terms; a zero or missing weight sum gives null."""
    return [
        safe_ratio(F.col(f"{n}__num").cast("double"), F.col(f"{n}__den").cast("double")).alias(n + suffix)
        for n in names
    ]


def weighted_means(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str,
    rows: str = "n_rows",
    weight_sum: str = "weight_sum",
    suffix: str = "_wmean",
) -> DataFrame:
    """Weighted mean of every value over rows where value and weight exist, with row and weight totals."""
    parts = weighted_parts({v: v for v in values}, weight)
    summed = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(rows),
        zero_sum(weight).alias(weight_sum),
        *[F.sum(term).alias(name) for name, term in parts.items()],
    )
    return summed.select(*keys, rows, weight_sum, *weighted_from_parts(values, suffix))


def snapshot_rollup(
    df: DataFrame,
    keys: Sequence[str],
    subarea: str,
    sums: Mapping[str, str],
    means: Mapping[str, str],
    aliases: Mapping[str, str],
    subarea_count: str,
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Distinct sub-areas, sums and means per entity, in one pass, plus aliases of results and constants.

    ``sums`` and ``means`` map output names to inputs, ``aliases`` map feature names to outputs. Inputs that
    do not exist are left out, and an alias of a missing output is null.
    """
    sums = {o: c for o, c in sums.items() if c in df.columns}
    means = {o: c for o, c in means.items() if c in df.columns}
    grouped = df.groupBy(*keys).agg(
        F.count_distinct(subarea).alias(subarea_count),
        *[zero_sum(c).cast("double").alias(o) for o, c in sums.items()],
        *[safe_ratio(F.sum(c).cast("double"), F.count(c)).alias(o) for o, c in means.items()],
    )
    known = {*sums, *means}
    return grouped.select(
        *keys,
        subarea_count,
        *[F.lit(v).alias(n) for n, v in (constants or {}).items()],
        *sums,
        *means,
        *[(F.col(o) if o in known else F.lit(None).cast("double")).alias(a) for a, o in aliases.items()],
    )


def located_parts(lat: Column | str, lon: Column | str) -> dict[str, Column]:
    """Per-row terms of a located count: row, located row, and the coordinates where both exist."""
    x = F.col(lat) if isinstance(lat, str) else lat
    y = F.col(lon) if isinstance(lon, str) else lon
    both = x.isNotNull() & y.isNotNull()
    return {
        "rows__sum": F.lit(1),
        "located__sum": F.when(both, 1).otherwise(0),
        "lat__sum": F.when(both, x),
        "lon__sum": F.when(both, y),
    }


def located_from_parts(rows: str, located: str, mean_lat: str, mean_lon: str) -> list[Column]:
    """Counts and mean coordinates out of summed terms; no located row gives null means."""
    return [
        F.col("rows__sum").alias(rows),
        F.col("located__sum").alias(located),
        safe_ratio(F.col("lat__sum").cast("double"), "located__sum").alias(mean_lat),
        safe_ratio(F.col("lon__sum").cast("double"), "located__sum").alias(mean_lon),
    ]


def located_counts(
    df: DataFrame, keys: Sequence[str], lat: str, lon: str, rows: str, located: str, mean_lat: str, mean_lon: str
) -> DataFrame:
    """Rows, rows with both coordinates, and the mean coordinates over those rows."""
    summed = df.groupBy(*keys).agg(*[F.sum(term).alias(name) for name, term in located_parts(lat, lon).items()])
    return summed.select(*keys, *located_from_parts(rows, located, mean_lat, mean_lon))


def wide_counts(
    df: DataFrame, keys: Sequence[str], category: str, columns: Mapping[str, str], total: str, log: str, n=None
) -> DataFrame:
    """Counts per category as columns, 0 where absent, all listed columns always present, total and log1p.

    Total and pivot come from the same grouping, so no join is needed; the fixed list saves the extra job
    that finds the categories. Categories outside the list count in the total only.
    """
    weight = F.lit(1) if n is None else F.col(n)
    grouped = df.groupBy(*keys).agg(
        F.sum(weight).cast("bigint").alias(total),
        *[
            F.coalesce(F.sum(F.when(F.col(category) == value, weight)), F.lit(0)).cast("bigint").alias(name)
            for value, name in columns.items()
        ],
    )
    return grouped.withColumn(log, F.log1p(F.col(total)))


def matrix(df: DataFrame, row: str, column: str, values: Sequence, measure: str, prefix: str = "") -> DataFrame:
    """Heat-map matrix: one row per entity, one column per listed period, 0 where absent."""
    pivoted = df.groupBy(row).pivot(column, list(values)).agg(F.sum(measure))
    return pivoted.select(
        row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"{prefix}{v}") for v in values]
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct whole-number values of each column with their counts, and the range of the column.

    One row per column and value: the values of a column are never gathered in one place.
    """
    long = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    values = long.dropna().groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    ranges = long.groupBy("column_name").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    return values.join(ranges, "column_name")


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, rows and share of nulls, from a single pass over the table."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"))
                for c in columns
            ]
        ).alias("parts"),
    )
    return counted.select("row_count", F.inline("parts")).select(
        "column_name",
        "null_count",
        "row_count",
        (F.col("null_count") / F.greatest(F.col("row_count"), F.lit(1))).alias("null_pct"),
    )


def counters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Independent row counters in one pass; a row may count in several."""
    return df.agg(
        *[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in conditions.items()]
    )


def group_means(df: DataFrame, key: str, means: Mapping[str, str], rows: str, digits: int | None = None) -> DataFrame:
    """Row count and means per group, optionally rounded."""

    def mean(col: str) -> Column:
        value = safe_ratio(F.sum(col).cast("double"), F.count(col))
        return value if digits is None else F.round(value, digits)

    return df.groupBy(key).agg(F.count(F.lit(1)).alias(rows), *[mean(c).alias(n) for n, c in means.items()])
