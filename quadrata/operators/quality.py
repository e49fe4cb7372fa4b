"""Data-quality checks, each a row (check_name, severity, passed, observed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.functions.names import bad_names
from quadrata.functions.numeric import row_sum
from quadrata.operators.sets import missing_keys, same_set

CRITICAL, WARNING = "critical", "warning"
CHECK_COLUMNS = ["check_name", "severity", "passed", "observed"]


def _rows(df: DataFrame, name: str, observed: Column, severity: str, passed: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"),
        (observed == 0 if passed is None else passed).alias("passed"),
        observed.cast("bigint").alias("observed"),
    )


def row_checks(df: DataFrame, violations: Mapping[str, Column], severity: str | Mapping[str, str] = CRITICAL) -> DataFrame:
    """Checks that no row violates a condition; all conditions of a table are counted in one scan.

    ``severity`` is that of all checks, or of the checks it names while the others are critical.
    """
    severities = dict.fromkeys(violations, severity) if isinstance(severity, str) else {**dict.fromkeys(violations, CRITICAL), **severity}
    parts = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severities[name]).alias("severity"),
            F.count_if(F.coalesce(bad, F.lit(False))).alias("observed"),
        )
        for name, bad in violations.items()
    ]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts")).select(
        "check_name", "severity", (F.col("observed") == 0).alias("passed"), "observed"
    )


def out_of_range(col: str, low, high) -> Column:
    return ~F.col(col).between(low, high)


def not_constant(col: str, value) -> Column:
    """Differs from the constant, or is null."""
    return ~F.col(col).eqNullSafe(F.lit(value))


def not_conserved(total: str, parts: Sequence[str]) -> Column:
    """The total is not the sum of its parts."""
    return ~F.col(total).eqNullSafe(row_sum(parts))


def outside_box(x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float]) -> Column:
    """Both coordinates are present and at least one lies outside; rows are reported, never dropped."""
    return (
        F.col(x).isNotNull() & F.col(y).isNotNull() & ~(F.col(x).between(*x_range) & F.col(y).between(*y_range))
    )


def unique_check(df: DataFrame, keys: Sequence[str], name: str, severity: str = CRITICAL) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").agg(F.count(F.lit(1)).alias("n"))
    return _rows(repeated, name, F.col("n"), severity)


def foreign_key_check(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str, severity: str = CRITICAL
) -> DataFrame:
    """Number of distinct keys in use that the dimension lacks."""
    lost = missing_keys(fact, dim, fact_key, dim_key).agg(F.count(F.lit(1)).alias("n"))
    return _rows(lost, name, F.col("n"), severity)


@dataclass(frozen=True)
class UniqueKey:
    """No two rows of ``table`` agree in all ``columns``; nulls agree with nulls."""

    name: str
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """Every value of ``table``.``column``, nulls aside, is a value of ``dim``.``dim_column``."""

    name: str
    table: str
    column: str
    dim: str
    dim_column: str


#: Key values longer than this travel as their SHA-256.
LONG_KEY = 64


def key_checks(tables: Mapping[str, DataFrame], keys: Sequence[UniqueKey | ForeignKey], severity: str = CRITICAL) -> DataFrame:
    """All key checks over all tables at once: one scan of each table, one shuffle, no join.

    A table emits a row for every key it takes part in: how often a value occurs, whether it is used as a foreign key and
    whether it is there to be referred to. These are folded per key and value, on the map side first, so a value that a third
    of the rows hold is one row per task. ``observed``: repeated values of a unique key, lost values of a foreign key.
    """
    parts: dict[str, list[Column]] = {}

    def add(table: str, i: int, values: Sequence[Column], used: bool, given: bool) -> None:
        texts = [F.when(F.octet_length(v) > LONG_KEY, F.concat(F.lit("\x00"), F.sha2(v, 256))).otherwise(v) for v in values]
        row = [F.lit(i).alias("i"), F.array(*texts).alias("key"), F.lit(1).cast("bigint").alias("n"), F.lit(used).alias("used"), F.lit(given).alias("given")]
        parts.setdefault(table, []).append(F.struct(*row))

    def kind(table: str, column: str) -> T.DataType:
        return tables[table].schema[column].dataType

    for i, k in enumerate(keys):
        if isinstance(k, UniqueKey):
            add(k.table, i, [F.col(c).cast("string") for c in k.columns], False, False)
            continue
        a, b = kind(k.table, k.column), kind(k.dim, k.dim_column)
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        alike = a == b or isinstance(a, whole) and isinstance(b, whole) or T.StringType() in (a, b)
        for table, column, used in ((k.table, k.column, True), (k.dim, k.dim_column, False)):
            value = F.col(column) if alike else F.col(column).cast("double")
            add(table, i, [value.cast("string")], used, not used)
    foreign = {i for i, k in enumerate(keys) if isinstance(k, ForeignKey)}
    rows = reduce(DataFrame.unionByName, [tables[t].select(F.inline(F.array(*own))) for t, own in parts.items()])
    rows = rows.where(~(F.col("i").isin(foreign) & F.col("key")[0].isNull())) if foreign else rows
    folded = rows.groupBy("i", "key").agg(F.sum("n").alias("n"), F.max("used").alias("used"), F.max("given").alias("given"))
    bad = F.when(F.col("i").isin(foreign), F.col("used") & ~F.col("given")).otherwise(F.col("n") > 1) if foreign else F.col("n") > 1
    counted = folded.groupBy("i").agg(F.count_if(bad).alias("n"))
    names = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k.name).alias("name")) for i, k in enumerate(keys)])
    spark = rows.sparkSession
    listed = spark.range(1).select(F.inline(names)).join(counted, "i", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return listed.select(
        F.col("name").alias("check_name"), F.lit(severity).alias("severity"), (F.col("n") == 0).alias("passed"), F.col("n").cast("bigint").alias("observed")
    )


def domain_check(df: DataFrame, col: str, allowed: Sequence, name: str, severity: str = CRITICAL) -> DataFrame:
    """Number of distinct non-null values outside the allowed list."""
    outside = df.where(~F.col(col).isin(list(allowed))).select(col).distinct().agg(F.count(F.lit(1)).alias("n"))
    return _rows(outside, name, F.col("n"), severity)


def cardinality_check(df: DataFrame, expected: int, name: str, severity: str = CRITICAL) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _rows(counted, name, F.col("n"), severity, F.col("n") == expected)


def set_check(left: DataFrame, right: DataFrame, name: str, severity: str = CRITICAL) -> DataFrame:
    """Two key sets are equal; observed is the number of keys on one side only."""
    compared = same_set(left, right)
    return _rows(compared, name, F.col("only_left") + F.col("only_right"), severity)


def balance_check(df: DataFrame, period: str, entity: str, expected: int, name: str) -> DataFrame:
    """Number of periods that do not hold the expected number of entities."""
    uneven = (
        df.groupBy(period)
        .agg(F.count_distinct(entity).alias("entities"))
        .agg(F.count_if(F.col("entities") != expected).alias("n"))
    )
    return _rows(uneven, name, F.col("n"), CRITICAL)


def no_empty_column_check(df: DataFrame, name: str) -> DataFrame:
    """Number of columns without a single value."""
    counted = df.agg(*[(F.count(F.col(f"`{c}`")) == 0).cast("bigint").alias(c) for c in df.columns])
    return _rows(counted, name, reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in df.columns]), CRITICAL)


def catalog_checks(
    catalog: DataFrame, roles: Sequence[str], static_features: Sequence[str], static_label: str,
    feature="feature_name", role="feature_role", temporal="temporal_behavior", recommended="recommended_for_modeling",
    derived_role: str = "derived_analysis",
) -> DataFrame:
    """Feature catalogue: every role occurs, all static features occur and say so, derived ones occur and are never recommended."""
    parts = [
        F.struct(
            F.lit("catalog_roles_complete").alias("check_name"),
            (F.lit(len(roles)) - F.count_distinct(F.when(F.col(role).isin(list(roles)), F.col(role)))).alias("observed"),
        ),
        F.struct(
            F.lit("catalog_static_features").alias("check_name"),
            (
                F.count_if(F.col(feature).isin(list(static_features)) & ~F.col(temporal).eqNullSafe(static_label))
                + (F.lit(len(set(static_features))) - F.count_distinct(F.when(F.col(feature).isin(list(static_features)), F.col(feature))))
            ).alias("observed"),
        ),
        F.struct(
            F.lit("catalog_derived_not_recommended").alias("check_name"),
            (
                F.count_if((F.col(role) == derived_role) & F.coalesce(F.col(recommended), F.lit(True)))
                + (F.count_if(F.col(role) == derived_role) == 0).cast("bigint")
            ).alias("observed"),
        ),
    ]
    return catalog.agg(F.array(*parts).alias("parts")).select(F.inline("parts")).select(
        "check_name", F.lit(CRITICAL).alias("severity"), (F.col("observed") == 0).alias("passed"), "observed"
    )


def forbidden_name_check(df: DataFrame, word: str, name: str, severity: str = CRITICAL) -> DataFrame:
    """Number of columns whose name contains a word, in any case."""
    found = sum(word.lower() in c.lower() for c in df.columns)
    return df.sparkSession.createDataFrame(
        [(name, severity, found == 0, found)], "check_name string, severity string, passed boolean, observed bigint"
    )


def schema_checks(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
    """Missing columns, wrong types and names that are not snake_case, from the schema alone."""
    actual = {f.name: f.dataType for f in df.schema}
    found = {
        "missing_columns": sum(f.name not in actual for f in contract),
        "unexpected_columns": len(set(actual) - set(contract.names)),
        "wrong_types": sum(f.name in actual and actual[f.name] != f.dataType for f in contract),
        "bad_names": len(bad_names(df.columns)),
    }
    rows = [(f"{table}.{k}", CRITICAL, v == 0, v) for k, v in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "check_name string, severity string, passed boolean, observed bigint"
    )


def stack(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows in one report."""
    return reduce(DataFrame.unionByName, [c.select(*CHECK_COLUMNS) for c in checks])


def summary(report: DataFrame) -> DataFrame:
    """Checks passed and failed per severity."""
    return report.groupBy("severity").agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )


def raise_on_critical(report: DataFrame) -> None:
    """Fail if a critical check failed; warnings never fail. The report has one row per check."""
    failed = report.where(~F.col("passed") & (F.col("severity") == CRITICAL)).select("check_name", "observed").collect()
    if failed:
        raise RuntimeError("; ".join(f"{r.check_name}: {r.observed}" for r in failed))
