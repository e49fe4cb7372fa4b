"""Dimensions and facts of the constellation schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.functions.dates import time_attributes
from quadrata.functions.numeric import stamp
from quadrata.operators.ordered import dense_key
from quadrata.operators.schema import conform
from quadrata.operators.sets import lookup_null_safe


def dim_time(
    keys: Sequence[DataFrame], time: str, month_names: Mapping[int, str], snapshot_keys: Iterable[int] = (),
    year: str = "year", names: Mapping[str, str] | None = None,
) -> DataFrame:
    """All time keys in use with their attributes. Frames with only a year contribute its annual key.

    Each frame is made distinct before the union. ``names`` renames the attribute columns.
    """
    snapshot_keys = list(snapshot_keys)
    spark = keys[0].sparkSession
    parts = [
        f.select((F.col(time) if time in f.columns else F.col(year) * 100).cast("int").alias(time)).dropna().distinct()
        for f in keys
    ]
    if snapshot_keys:
        parts.append(spark.createDataFrame([(k,) for k in snapshot_keys], f"{time} int"))
    every = reduce(DataFrame.unionByName, parts).distinct()
    attributes = time_attributes(time, month_names, snapshot_keys)
    names = names or {}
    return every.select(time, *[c.alias(names.get(n, n)) for n, c in attributes.items()])


def dim_natural(df: DataFrame, columns: Sequence[str], required: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """Distinct rows of a natural key, numbered 1..n in the given order, nulls last.

    Rows without a required column are dropped. Columns outside the order break ties, which makes the
    numbering reproducible.
    """
    distinct = df.select(*columns).dropna(subset=list(required)).dropDuplicates()
    return dense_key(distinct, [*order, *[c for c in columns if c not in order]], key)


def dim_static(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Catalogue dimension from fixed rows, as literals of a one-row frame: the optimiser knows that it is small."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    members = [F.struct(*[F.lit(v).cast(k.dataType).alias(k.name) for v, k in zip(row, kinds, strict=True)]) for row in rows]
    if not members:
        return spark.createDataFrame([], kinds)
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*members)))


def fact(df: DataFrame, columns: Sequence[str], constants: Mapping[str, object] | None = None) -> DataFrame:
    """Fact projection: provenance constants added, columns in contract order."""
    return stamp(df, constants or {}).select(*columns)


def fact_conformed(df: DataFrame, contract: T.StructType, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Fact projection by contract; columns the source lacks become null."""
    return conform(stamp(df, constants or {}), contract)


def fact_by_member(df: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """Add the surrogate key of a member list; members without one keep a null key."""
    return df.join(members, on, "left")


def fact_by_natural_key(df: DataFrame, dim: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    return lookup_null_safe(df, dim, natural, key)
