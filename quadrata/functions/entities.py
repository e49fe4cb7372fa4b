"""Canonical entities: codes, aliases, display names and surrogate ids."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions.text import lookup, strip_spaces, text_key, with_text_keys


@dataclass(frozen=True)
class EntityCatalog:
    """Ordered canonical keys (id = position), their numeric codes and the aliases that lead to them."""

    keys: tuple[str, ...]
    codes: Mapping[int, str]
    aliases: Mapping[str, str]
    affixes: tuple[str, ...] = ()
    ids: Mapping[str, int] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "ids", {key: i for i, key in enumerate(self.keys, 1)})

    def _code(self, raw: Column) -> Column:
        whole = F.when(raw.rlike(r"^[0-9]+(\.0+)?$"), raw).try_cast("double").try_cast("int")
        return lookup(self.codes, whole)

    # Words of a key are separated by single blanks.

    def _without_prefix(self, key: Column) -> Column:
        cut = [(key.startswith(f"{word} "), F.substring(key, len(word) + 2, 1 << 30)) for word in self.affixes]
        bare = key
        for starts, rest in reversed(cut):
            bare = F.when(starts, rest).otherwise(bare)
        return bare

    def _without_suffix(self, key: Column) -> Column:
        return F.regexp_replace(key, rf" ({'|'.join(self.affixes)})$", "") if self.affixes else key

    def _has_suffix(self, key: Column) -> Column:
        return reduce(lambda a, b: a | b, [key.endswith(f" {word}") for word in self.affixes], F.lit(False))

    def _spelling(self, key: Column) -> Column:
        return lookup(self.aliases, self._without_suffix(self._without_prefix(key)))

    def canonical(self, col: Column | str) -> Column:
        """Key of a code (whole number, also as text such as ``010.0``) or of a spelling, else null."""
        raw = strip_spaces((F.col(col) if isinstance(col, str) else col).cast("string"))
        return F.coalesce(self._code(raw), self._spelling(text_key(raw)))

    def first_canonical(self, primary: Column | str, secondary: Column | str) -> Column:
        return F.coalesce(self.canonical(primary), self.canonical(secondary))

    def with_canonical(self, df: DataFrame, out: str, *sources: Column | str, also: Mapping[str, Column | str] | None = None) -> DataFrame:
        """Add the canonical key of the first source that has one, and ``also`` further text keys in the same steps.

        Same result as the expressions above, computed in steps so that no intermediate value is repeated. A source is only
        spelled out where neither it nor one before it holds a code.
        """
        raws, codes, keys = [[f"_{kind}_{i}" for i in range(len(sources))] for kind in ("raw", "code", "text")]
        columns = [F.col(s) if isinstance(s, str) else s for s in sources]
        df = df.withColumns({r: c.cast("string") for r, c in zip(raws, columns, strict=True)})
        df = df.withColumns({r: strip_spaces(r) for r in raws})
        df = df.withColumns({c: self._code(F.col(r)) for r, c in zip(raws, codes)})
        uncoded = [F.coalesce(*[F.col(c) for c in codes[: i + 1]]).isNull() for i in range(len(sources))]
        df = with_text_keys(df, {**{k: F.when(none, F.col(r)) for k, r, none in zip(keys, raws, uncoded)}, **(also or {})})
        df = df.withColumns({k: self._without_prefix(F.col(k)) for k in keys})
        ends = {k: F.when(self._has_suffix(F.col(k)), self._without_suffix(F.col(k))).otherwise(F.col(k)) for k in keys}
        df = df.withColumns(ends)
        found = [c for code, k in zip(codes, keys) for c in (F.col(code), lookup(self.aliases, F.col(k)))]
        return df.withColumn(out, F.coalesce(*found)).drop(*raws, *codes, *keys)

    def name(self, key: Column | str) -> Column:
        return lookup({k: k.title() for k in self.keys}, F.col(key) if isinstance(key, str) else key)

    def id(self, key: Column | str) -> Column:
        return lookup(dict(self.ids), F.col(key) if isinstance(key, str) else key)

    def contains(self, key: Column | str) -> Column:
        return F.coalesce((F.col(key) if isinstance(key, str) else key).isin(list(self.keys)), F.lit(False))

    def frame(self, spark: SparkSession) -> DataFrame:
        """Catalogue as a table: id, key, name, code."""
        code_of = {key: code for code, key in self.codes.items()}
        rows = [(i, key, key.title(), code_of.get(key)) for key, i in self.ids.items()]
        return spark.createDataFrame(
            rows, "entity_id int, entity_key string, entity_name string, entity_code int"
        )


def canonicalize_by_table(df: DataFrame, source: str, aliases: DataFrame, target: str) -> DataFrame:
    """Alias lookup against a table (alias, entity_key) for catalogues too large for an expression.

    The join is a plain left join on the text key: Spark broadcasts the catalogue when it is small and
    shuffles otherwise.
    """
    keyed = df.withColumn("_alias", text_key(source))
    table = aliases.select(F.col("alias").alias("_alias"), F.col("entity_key").alias(target))
    return keyed.join(table, "_alias", "left").drop("_alias")
