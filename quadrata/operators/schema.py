"""Contracts: conforming to an ordered schema, type labels and type inference."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.functions.numeric import try_double


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the ordered contract; columns the input lacks become typed nulls, others are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def dtype_label(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    return "numeric" if isinstance(data_type, T.NumericType) else "text"


# Naming conventions that fix a type. Number types are only a hint: fractional data is double in any case.
TypeRule = tuple[Callable[[str], object], str]

# The order of the rules and the names they list.
NAME_RULES: tuple[TypeRule, ...] = (
    (re.compile(r"^fecha_").search, "date"),
    (re.compile(r"^hora_").search, "time"),
    (re.compile(r"^is_robo_patrimonial$").search, "integer"),
    (re.compile(r"^es_|_snapshot$|^recomendada_|^recommended_for_modeling$").search, "boolean"),
    (re.compile(r"_id$").search, "integer"),
    (
        {
            "anio", "mes", "trimestre", "municipio_enigh", "cve_ent", "infraestructura_actualizacion_anio",
            "n_registros_sociales", "registros_con_coordenadas",
        }.__contains__,
        "integer",
    ),
    (re.compile(r"^total_|_total$|_sum$|_count$|^robo_").search, "bigint"),
    (re.compile(r"^share_|_log1p$").search, "double"),
    ({"latitud", "longitud", "latitud_promedio", "longitud_promedio"}.__contains__, "double"),
    (re.compile(r"_wmean|_avg|_mean|_promedio|_pct|factor_sum|resid_ton").search, "double"),
)


def infer_types(df: DataFrame, rules: Sequence[TypeRule] = NAME_RULES, sample: int | None = None) -> DataFrame:
    """Type of every text column by name rule, else by content: (column_name, inferred_type, non_null).

    One pass counts values, numbers and whole numbers of all columns. All whole gives bigint, all numeric
    gives double, anything else and empty columns give text. A whole-number rule gives way to double where
    the data is fractional. ``sample`` bounds the rows read; the default is the whole table.
    """
    rows = df if sample is None else df.limit(sample)
    rows = rows.select(*[F.col(f"`{name}`").cast("string").alias(f"t{i}") for i, name in enumerate(df.columns)])
    rows = rows.select("*", *[try_double(f"t{i}").alias(f"n{i}") for i in range(len(df.columns))])  # every number is read once
    parts = []
    for i, name in enumerate(df.columns):
        ruled = next((kind for test, kind in rules if test(name)), None)
        parts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(ruled).alias("ruled"),
                F.count(f"t{i}").alias("non_null"),
                F.count(f"n{i}").alias("numeric"),
                F.count_if(F.col(f"n{i}") % 1 == 0).alias("whole"),
            )
        )
    counted = rows.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
    all_numeric = (F.col("non_null") > 0) & (F.col("numeric") == F.col("non_null"))
    fractional = all_numeric & (F.col("whole") < F.col("non_null"))
    by_content = F.when(~all_numeric, "text").when(fractional, "double").otherwise("bigint")
    whole_rule = F.col("ruled").isin("integer", "bigint")
    return counted.select(
        "column_name",
        F.when(whole_rule & fractional, "double")
        .otherwise(F.coalesce(F.col("ruled"), by_content))
        .alias("inferred_type"),
        "non_null",
    )
