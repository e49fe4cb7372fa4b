"""Tolerant numbers, safe shares, horizontal sums and fills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# All texts that a cast to double reads, and few others, but those that end in a d or f (blanks after it aside). The cast itself
# throws and catches an error for every text it cannot read.
_DIGITS = r"(?:[0-9.]+(?:[eE][+-]?[0-9]+)?|0[xX][0-9a-fA-F.]+[pP][+-]?[0-9]+)"
_NUMBER_LIKE = (
    rf"^[\x00-\x20]*[+-]?(?:{_DIGITS}|(?i:infinity)|(?:{_DIGITS}[dDfF]|(?i:inf))(?=[\x00-\x20]*[\x00-\x1f]))[\x00-\x20]*$"
)


def try_double(col: Column | str) -> Column:
    """Number or null: no error on bad text, no NaN, no Java type suffix such as ``1d``.

    Text that does not look like a number is told by a pattern, so a column full of it costs no errors; the rest is cast once.
    """
    value = _column(col)
    readable = ~F.typeof(value).startswith("string") | value.cast("string").rlike(_NUMBER_LIKE)
    return F.nanvl(F.when(readable, value.try_cast("double")), F.lit(None).cast("double"))


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the listed columns that exist to double, bad values to null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: try_double(c) for c in present})


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null for a zero or null denominator."""
    return _column(numerator) / F.nullif(_column(denominator), F.lit(0))


def share(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio with a missing numerator taken as zero."""
    return safe_ratio(F.coalesce(_column(numerator), F.lit(0)), denominator)


def row_sum(columns: Sequence[Column | str]) -> Column:
    """Horizontal sum, null counted as zero."""
    return reduce(add, [F.coalesce(_column(c), F.lit(0)) for c in columns])


def row_mean(columns: Sequence[Column | str]) -> Column:
    """Horizontal mean, null if any part is null."""
    return reduce(add, [_column(c) for c in columns]) / F.lit(len(columns))


def fill(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls per column by a constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def keep_where(condition: Column, col: Column | str) -> Column:
    """The value where the condition holds, else null."""
    return F.when(condition, _column(col))


def stamp(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    """Add constant provenance columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def inside_box(
    x: Column | str, y: Column | str, x_range: tuple[float, float], y_range: tuple[float, float]
) -> Column:
    """Both coordinates present and inside the box, borders included; false if one is missing."""
    return F.coalesce(_column(x).between(*x_range) & _column(y).between(*y_range), F.lit(False))
