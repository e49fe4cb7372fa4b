"""Column names: normal form, duplicates, synonyms. Name lists are metadata and live on the driver."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.functions.text import strip_accents, strip_spaces

# The name of an unnamed column and the prefix of a name that starts with a digit.
UNNAMED = "columna"
DIGIT_PREFIX = "c_"

SNAKE_CASE = r"^[a-z][a-z0-9_]*$"


def snake_case(name: str) -> str:
    decomposed = unicodedata.normalize("NFKD", name)
    plain = "".join(c for c in decomposed if not unicodedata.combining(c)).lower()
    joined = "_".join(re.findall("[a-z0-9]+", plain)) or UNNAMED
    return DIGIT_PREFIX + joined if joined[0].isdigit() else joined


def snake_case_col(col: Column | str) -> Column:
    """The same rule for values of a column."""
    plain = F.lower(strip_spaces(strip_accents(col)))
    joined = F.btrim(F.regexp_replace(plain, "[^a-z0-9]+", "_"), F.lit("_"))
    named = F.when(joined == "", F.lit(UNNAMED)).otherwise(joined)
    return F.when(named.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), named)).otherwise(named)


def dedupe_names(names: Iterable[str]) -> list[str]:
    """Normal forms in order; the n-th repeat of a name carries the suffix ``_n``, or the next number that is free."""
    plain = [snake_case(name) for name in names]
    taken, seen = set(plain), {}
    result = []
    for name in plain:
        n = seen[name] = seen.get(name, 0) + 1
        if n == 1:
            result.append(name)
            continue
        while f"{name}_{n}" in taken:
            n += 1
        seen[name] = n
        taken.add(f"{name}_{n}")
        result.append(f"{name}_{n}")
    return result


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*dedupe_names(df.columns))


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


def bad_names(names: Sequence[str]) -> list[str]:
    """Names that are not snake_case."""
    return [name for name in names if not re.fullmatch(SNAKE_CASE, name)]


def is_snake_case(col: Column | str) -> Column:
    text = F.col(col) if isinstance(col, str) else col
    return text.rlike(SNAKE_CASE)
