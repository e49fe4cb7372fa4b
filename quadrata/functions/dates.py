"""Tolerant dates and the integer time key YYYYMM (month 00 for a whole year)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.functions.numeric import try_double
from quadrata.functions.text import lookup, text_key

# Years a nanosecond timestamp can hold; the accepted input range of dates.
FIRST_YEAR, LAST_YEAR = 1678, 2261


def _accepted(value: Column) -> Column:
    return F.when(value.between(F.lit(date(FIRST_YEAR, 1, 1)), F.lit(date(LAST_YEAR, 12, 31))), value)


def parse_date(col: Column | str) -> Column:
    """Date from ISO text, null if it cannot be read or lies outside the accepted years."""
    return _accepted((F.col(col) if isinstance(col, str) else col).try_cast("date"))


def with_dates(df: DataFrame, dates: Mapping[str, str]) -> DataFrame:
    """Add dates, ``{new column: source}``, as :func:`parse_date` reads them, in steps that read every text once."""
    return df.withColumns({n: F.col(s).try_cast("date") for n, s in dates.items()}).withColumns({n: _accepted(F.col(n)) for n in dates})


def iso_date(col: Column | str) -> Column:
    """Text yyyy-MM-dd of a date of four-digit years; no time of day or time zone is involved."""
    return (F.col(col) if isinstance(col, str) else col).cast("date").cast("string")


def month_of_key(key: Column, names: Mapping[str, int]) -> Column:
    """Month 1..12 of a text key that is a number or a month name, else null."""
    table = {**{str(month): month for month in range(1, 13)}, **names}
    return lookup(table, F.regexp_replace(key, "^0+(?=[0-9])", ""))


def parse_month(col: Column | str, names: Mapping[str, int], numeric: bool = False) -> Column:
    """Month 1..12 from a whole number, digit text or a month name; anything else is null.

    ``numeric`` tells that the column holds numbers rather than text.
    """
    value = F.col(col) if isinstance(col, str) else col
    if numeric:
        whole = F.when(value == F.floor(value), value).try_cast("int")
        return F.when(whole.between(1, 12), whole)
    return month_of_key(text_key(value), names)


def time_id(year: Column | str, month: Column | str | int = 0) -> Column:
    """year * 100 + month; a missing month counts as 0, an unreadable part makes the key null."""
    year_number = try_double(year).try_cast("int")
    if isinstance(month, int):
        return year_number * 100 + F.lit(month)
    raw = F.col(month) if isinstance(month, str) else month
    month_number = F.when(raw.isNull(), F.lit(0)).otherwise(try_double(raw).try_cast("int"))
    return year_number * 100 + month_number


def in_years(date: Column | str, first: int, last: int) -> Column:
    """The date lies in one of the years, as a range of the column itself, which a Parquet reader can use."""
    value = F.col(date) if isinstance(date, str) else date
    return (value >= F.lit(f"{first:04d}-01-01")) & (value < F.lit(f"{last + 1:04d}-01-01"))


def time_attributes(
    key: Column | str, month_names: Mapping[int, str], snapshot_keys: Iterable[int] = ()
) -> dict[str, Column]:
    """Year, month, month name, quarter and granularity of a time key.

    Month 0 is the annual member: its name and granularity are ``anual``, and ``anual_snapshot`` marks the
    keys of a snapshot.
    """
    tid = F.col(key) if isinstance(key, str) else key
    month = (tid % 100).cast("int")
    snapshot = tid.isin(list(snapshot_keys)) if list(snapshot_keys) else F.lit(False)
    return {
        "year": F.floor(tid / 100).cast("int"),
        "month": month,
        "month_name": F.when(month == 0, F.lit("anual")).otherwise(lookup(month_names, month)),
        "quarter": F.ceil(month / 3).cast("int"),
        "granularity": F.when(month != 0, F.lit("mensual"))
        .when(snapshot, F.lit("anual_snapshot"))
        .otherwise(F.lit("anual")),
    }
