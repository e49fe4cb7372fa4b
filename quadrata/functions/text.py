"""Text keys, labels and keyword classification as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that Python's str.strip() removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Hangul syllables are composed by arithmetic: 21 vowels and 28 endings (the first of them none) per leading consonant.
_HANGUL, _HANGUL_END, _VOWELS, _ENDINGS = 0xAC00, 0xD7A4, 21, 28
_LEADS_OF, _VOWELS_OF, _ENDINGS_OF = ("".join(map(chr, span)) for span in (range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)))


@cache
def _decompositions() -> tuple[str, str, str, dict[str, str]]:
    """(one-to-one sources, their targets, dropped marks, one-to-many expansions) of all code points but Hangul, by the NFKD rule.

    Marks that move during normalisation are all dropped, so a text may be treated character by character.
    """
    source, target, dropped, expanded = [], [], [], {}
    for code in (*range(0x80, _HANGUL), *range(_HANGUL_END, 0xD800), *range(0xE000, 0x110000)):
        char = chr(code)
        if unicodedata.is_normalized("NFKD", char) and not unicodedata.combining(char):
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if not plain:
            dropped.append(char)
        elif len(plain) == 1:
            source.append(char)
            target.append(plain)
        else:
            expanded[char] = plain
    return "".join(source), "".join(target), "".join(dropped), expanded


def _syllable(char: Column) -> Column:
    """Consonant, vowel and ending of a Hangul syllable; null for any other character."""
    place = F.ascii(char) - _HANGUL
    ending = F.pmod(place, F.lit(_ENDINGS))
    vowel = F.pmod(F.floor(place / _ENDINGS), F.lit(_VOWELS)).cast("int")
    lead = F.floor(place / (_VOWELS * _ENDINGS)).cast("int")
    parts = F.concat(
        F.substring(F.lit(_LEADS_OF), lead + 1, F.lit(1)),
        F.substring(F.lit(_VOWELS_OF), vowel + 1, F.lit(1)),
        F.when(ending > 0, F.substring(F.lit(_ENDINGS_OF), ending, F.lit(1))).otherwise(""),
    )
    return F.when(place.between(0, _HANGUL_END - _HANGUL - 1), parts)


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def lookup(table: Mapping, key: Column) -> Column:
    """Value of a small fixed table, null for an unknown key; one constant map in the plan.

    Keys and values may be text or integers.
    """
    pairs = "\x1e".join(f"{k}\x1f{v}" for k, v in table.items())
    found = F.try_element_at(F.str_to_map(F.lit(pairs), F.lit("\x1e"), F.lit("\x1f")), key.cast("string"))
    return found.cast("int") if all(isinstance(v, int) for v in table.values()) else found


def strip_accents(col: Column | str) -> Column:
    """Compatibility-decompose and drop combining marks.

    ASCII values pass through untouched. The rare characters that decompose to several letters, and Hangul, are expanded
    letter by letter, only in the values that hold one. The argument is used several times: pass a column
    rather than a long expression.
    """
    text = F.col(col) if isinstance(col, str) else col
    source, target, dropped, expanded = _decompositions()
    letters = F.transform(F.split(text, ""), lambda c: F.coalesce(lookup(expanded, c), _syllable(c), c))
    has_none = text.rlike(r"^[\x00-\x7F\xC0-\xFF]*+$") | (
        (F.char_length(F.translate(text, "".join(expanded), "")) == F.char_length(text))
        & ~text.rlike(f"[{chr(_HANGUL)}-{chr(_HANGUL_END - 1)}]")
    )
    wide = F.when(has_none, text).otherwise(F.concat_ws("", letters))
    return F.when(_is_ascii(text), text).otherwise(F.translate(wide, source + dropped, target))


def strip_accents_nfkd(col: Column | str) -> Column:
    """The same rule as a vectorised UDF, for text that is mostly made of characters which decompose to several."""
    @F.pandas_udf(T.StringType())
    def decompose(values: pd.Series) -> pd.Series:
        def plain(value):
            if value is None:
                return None
            return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

        return values.map(plain)

    return decompose(col)


def _ends_visibly(text: Column) -> Column:
    """The first and the last character are visible ASCII characters (of a text in binary collation)."""
    return text.between("!", "~") & F.substring(text.cast("binary"), -1, 1).between(F.lit(b"!"), F.lit(b"~"))


def strip_spaces(col: Column | str) -> Column:
    """Trim every Unicode blank on both sides, not only the space character.

    Trimming compares both ends with every blank. A column given by name, in binary collation, is only trimmed where its ends
    may be blanks; an expression would be computed once per use, so it is always trimmed.
    """
    trimmed = F.btrim(col, F.lit(WHITESPACE))
    return F.when(_ends_visibly(F.col(col)), F.col(col)).otherwise(trimmed) if isinstance(col, str) else trimmed


def _words(upper: Column) -> Column:
    return F.regexp_replace(upper, "[^A-Z0-9]+", " ")


def _is_words(upper: Column) -> Column:
    return upper.rlike(r"^[A-Z0-9 ]*+\z") & ~upper.contains("  ")


def text_key(col: Column | str, plain: Column | None = None) -> Column:
    """Upper-case ASCII key: letters and digits, single blanks between words, empty becomes null.

    ``plain`` replaces the accent-free form, e.g. with :func:`strip_accents_nfkd`.
    """
    return F.nullif(F.trim(_words(F.upper(strip_accents(col) if plain is None else plain))), F.lit(""))


def with_text_keys(df: DataFrame, keys: Mapping[str, Column | str]) -> DataFrame:
    """Add text keys, ``{new column: source}``, in steps that compute every intermediate value once.

    Text that already consists of words and single blanks is told by one match and not rewritten.
    """
    stages = {name: f"_key_{i}" for i, name in enumerate(keys)}
    raw = {stages[n]: F.col(s) if isinstance(s, str) else s for n, s in keys.items()}
    df = df.withColumns(raw)
    df = df.withColumns({c: strip_accents(c) for c in raw})
    df = df.withColumns({c: F.upper(c) for c in raw})
    df = df.withColumns({c: F.trim(F.when(_is_words(F.col(c)), F.col(c)).otherwise(_words(F.col(c)))) for c in raw})
    return df.withColumns({name: F.nullif(F.col(c), F.lit("")) for name, c in stages.items()}).drop(*raw)


def pin(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with the columns passed through a one-element array.

    The optimiser moves a filter below the projections that compute its columns and writes their expressions
    into it, once per reference; with several steps that multiplies. It does not move one below this.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def title_label(key: Column | str) -> Column:
    """Capital at the start of every run of letters, also after a digit (``1RA`` gives ``1Ra``)."""
    text = F.col(key) if isinstance(key, str) else key
    runs = F.regexp_extract_all(text, F.lit("([A-Z]+|[^A-Z]+)"), F.lit(1))
    after_digit = F.concat_ws("", F.transform(runs, F.initcap))
    return F.when(text.rlike("[^A-Z ][A-Z]"), after_digit).otherwise(F.initcap(text))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns; other columns are left alone."""
    return df.select(
        *[
            strip_spaces(f"`{f.name}`" if f.dataType == T.StringType() else F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


@dataclass(frozen=True)
class Rule:
    """A label and the words that must all occur, of which one must occur, or which must not occur."""

    label: str
    all_of: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()

    def condition(self, key: Column) -> Column:
        test = F.lit(True)
        for word in self.all_of:
            test = test & key.contains(word)
        if self.any_of:
            hit = F.lit(False)
            for word in self.any_of:
                hit = hit | key.contains(word)
            test = test & hit
        for word in self.none_of:
            test = test & ~key.contains(word)
        return test


def classify_rules(key: Column | str, rules: Sequence[Rule], default: str) -> Column:
    """Label of the first rule that holds for the text key; the default for none and for null."""
    text = F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(""))
    label = None
    for rule in rules:
        branch = F.when if label is None else label.when
        label = branch(rule.condition(text), F.lit(rule.label))
    return F.lit(default) if label is None else label.otherwise(F.lit(default))


def flag_in(col: Column | str, values: Iterable[str]) -> Column:
    """1 where the value is in the list, else 0 (also for null)."""
    text = F.col(col) if isinstance(col, str) else col
    return F.coalesce(text.isin(list(values)), F.lit(False)).cast("int")


def to_bool(col: Column | str) -> Column:
    """True for ``true`` or ``1`` in any case, false for anything else and for null."""
    text = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lower(text.cast("string")).isin("true", "1"), F.lit(False))


def is_utf8(col: Column | str) -> Column:
    """Whether bytes are valid UTF-8."""
    raw = F.col(col) if isinstance(col, str) else col
    return F.is_valid_utf8(raw.cast("string"))
