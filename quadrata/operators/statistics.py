"""Correlation, standardisation, imputation and simple regression as one-pass aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.operators import gramian
from quadrata.operators.ordered import exact_quantiles


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int | None = None) -> DataFrame:
    """(feature_a, feature_b, corr) for the listed pairs, all from one aggregation.

    Each pair uses the rows where both values exist; a constant column gives null. The aggregation yields the
    moments only, and the quotient is formed on one row per pair, which keeps the plan small.
    """

    def moments(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        return F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.covar_pop(x, y).alias("cov"),
            F.stddev_pop(F.when(both, x)).alias("sx"),
            F.stddev_pop(F.when(both, y)).alias("sy"),
        )

    rows = df.agg(F.array(*[moments(a, b) for a, b in pairs]).alias("pairs")).select(F.inline("pairs"))
    spread = rows.withColumn("spread", F.col("sx") * F.col("sy"))
    corr = F.when(F.col("spread") != 0, F.col("cov") / F.col("spread"))
    return spread.select("feature_a", "feature_b", _rounded(corr, digits).alias("corr"))


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits) + 0.0


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Long form of the symmetric matrix; the mirrored half is derived from the computed one.

    Each pair uses the rows where both values exist; a constant column gives null. Any number of columns takes one pass.
    """
    moments = gramian.pair_moments(df, columns)
    upper = gramian.named(moments, columns, _rounded(gramian.correlation(), digits), "corr")
    a, b = F.col("feature_a"), F.col("feature_b")
    sides = F.array_distinct(
        F.array(F.struct(a.alias("row"), b.alias("column")), F.struct(b.alias("row"), a.alias("column")))
    )
    mirrored = upper.select("corr", F.inline(sides))
    return mirrored.select(F.col("row").alias("feature_a"), F.col("column").alias("feature_b"), "corr")


def target_corr(df: DataFrame, features: Sequence[str], target: str, digits: int | None = None) -> DataFrame:
    """Correlation of each feature with the target, largest first, undefined ones last."""
    return (
        correlations(df, [(f, target) for f in features], digits)
        .select(F.col("feature_a").alias("feature"), "corr")
        .orderBy(F.col("corr").desc_nulls_last(), "feature")
    )


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Population z-scores; a constant column gives 0, a missing value stays missing. Mean and deviation come from one scalar subquery."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).alias("stats")
    ).scalar()
    return df.withColumns(
        {
            c + suffix: F.when(F.col(c).isNull(), None)
            .when(stats[f"s_{c}"] == 0, 0.0)
            .otherwise((F.col(c) - stats[f"m_{c}"]) / F.nullif(stats[f"s_{c}"], F.lit(0.0)))
            for c in columns
        }
    )


def covariance_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(feature_a, feature_b, covariance) of the upper triangle, population form, over the rows that have both values."""
    return gramian.named(gramian.pair_moments(df, columns), columns, _rounded(gramian.covariance(), digits), "covariance")


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the exact median of the column; an all-null column stays null."""
    medians = {r.column_name: r.value for r in exact_quantiles(df, columns).collect()}  # one row per column
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in columns if c in medians})


def student_tail():
    """Function (t, dof) -> two-sided tail of Student's t: the incomplete beta function I_x(dof/2, 1/2).

    It is built inside a function so that it travels to the Python workers by value.
    """

    def fraction(p: float, q: float, z: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1.0 - (p + q) * z / (p + 1.0)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 400):
            for step in (
                m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
                -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)),
            ):
                d = 1.0 + step * d
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = 1.0 + step / c
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1.0) < 1e-15:
                break
        return h

    def two_sided(t: float, dof: float) -> float:
        a, b, x = dof / 2.0, 0.5, dof / (dof + t * t)
        if x >= 1.0 or x <= 0.0:
            return 1.0 if x >= 1.0 else 0.0
        scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        front = math.exp(scale + a * math.log(x) + b * math.log1p(-x))
        if x < (a + 1.0) / (a + b + 2.0):
            return front * fraction(a, b, x) / a
        return 1.0 - front * fraction(b, a, 1.0 - x) / b

    return two_sided


def linregress(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, slope, intercept, r, r_squared, std_err, t and the two-sided p-value of the slope."""
    two_sided = student_tail()

    @F.pandas_udf(T.DoubleType())
    def p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([two_sided(a, b) if a == a and b > 0 else None for a, b in zip(t, dof)], dtype="float64")

    both = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    moments = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"),
        F.var_pop("y").alias("vy"),
        F.covar_pop("x", "y").alias("cxy"),
    )
    fit = (
        moments.withColumn("slope", F.col("cxy") / F.nullif("vx", F.lit(0.0)))
        .withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
        .withColumn("r", F.col("cxy") / F.nullif(F.sqrt(F.col("vx") * F.col("vy")), F.lit(0.0)))
        .withColumn("r_squared", F.col("r") * F.col("r"))
        .withColumn("dof", (F.col("n") - 2).cast("double"))
        .withColumn(
            "std_err",
            F.sqrt((1 - F.col("r_squared")) * F.col("vy") / F.nullif("vx", F.lit(0.0)) / F.nullif("dof", F.lit(0.0))),
        )
        .withColumn("t", F.col("slope") / F.nullif("std_err", F.lit(0.0)))
    )
    return fit.select("n", "slope", "intercept", "r", "r_squared", "std_err", "t", p_value("t", "dof").alias("p_value"))
