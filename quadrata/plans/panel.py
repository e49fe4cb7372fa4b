"""The entity-by-period panel, its modelling projection and the feature catalogue."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.functions.numeric import fill, share
from quadrata.functions.text import lookup
from quadrata.operators.schema import dtype_label
from quadrata.operators.sets import common_periods


@dataclass(frozen=True)
class PanelSpec:
    key: str
    year: str
    total: str  # all events
    target: str  # flagged events
    log: str
    parts: tuple[str, ...]  # class columns of the target
    target_share: str
    features: tuple[str, ...]  # snapshot features to replicate over the periods
    constants: Mapping[str, object]  # provenance of the snapshot
    preferred: tuple[int, ...] = ()
    extra: tuple[str, ...] = ()  # further snapshot columns


def build_panel(base: DataFrame, general: DataFrame, target: DataFrame, snapshot: DataFrame, spec: PanelSpec) -> DataFrame:
    """Survey rows of the common periods, left-joined with counts, target and the time-invariant snapshot.

    Missing counts become 0, shares over an empty target stay null, missing provenance is filled.
    """
    on = [spec.key, spec.year]
    periods = common_periods([base, general], spec.year, spec.preferred)
    panel = (
        base.join(periods, spec.year, "left_semi")
        .join(general.select(*on, spec.total), on, "left")
        .join(target.select(*on, spec.target, *spec.parts), on, "left")
    )
    panel = fill(panel, {c: 0 for c in [spec.total, spec.target, *spec.parts]})
    panel = panel.withColumns(
        {
            spec.log: F.log1p(spec.target),
            spec.target_share: share(spec.target, spec.total),
            **{f"share_{p}": share(p, spec.target) for p in spec.parts},
        }
    )
    carried = [c for c in [*spec.extra, *spec.features, *spec.constants] if c in snapshot.columns]
    panel = panel.join(snapshot.select(spec.key, *carried), spec.key, "left")
    absent = {c: F.lit(v) for c, v in spec.constants.items() if c not in carried}
    return fill(panel.withColumns(absent), {c: v for c, v in spec.constants.items() if c in carried})


def modeling_panel(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordered projection; no imputation and no scaling. Columns the panel lacks become null."""
    return panel.select(*[F.col(c) if c in panel.columns else F.lit(None).cast("double").alias(c) for c in columns])


@dataclass(frozen=True)
class FeatureRule:
    """Catalogue entry for the columns it applies to; text may hold ``{name}``."""

    applies: Callable[[str], bool]
    role: str
    source: str
    description: str
    leakage: str
    recommended: bool
    temporal: str
    notes: str = ""


CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("feature_name", T.StringType()),
        T.StructField("source_dataset", T.StringType()),
        T.StructField("feature_role", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("leakage_risk", T.StringType()),
        T.StructField("recommended_for_modeling", T.BooleanType()),
        T.StructField("temporal_behavior", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FeatureRules:
    rules: Sequence[FeatureRule]
    default: FeatureRule
    base_name: Callable[[str], str] = field(default=lambda name: name)

    def first(self, name: str) -> FeatureRule:
        return next((r for r in self.rules if r.applies(name)), self.default)


def feature_catalog(panel: DataFrame, rules: FeatureRules, dictionary: DataFrame | None = None) -> DataFrame:
    """One row per panel column: the first rule that applies, and the type from the schema.

    A dictionary table (variable, description) overrides the description of features.
    """
    rows = []
    for column in panel.schema:
        rule, base = rules.first(column.name), rules.base_name(column.name)
        rows.append(
            (
                column.name, rule.source, rule.role, dtype_label(column.dataType), rule.description.format(name=base),
                rule.leakage, rule.recommended, rule.temporal, rule.notes,
            )
        )
    catalog = panel.sparkSession.createDataFrame(rows, CATALOG_SCHEMA)
    if dictionary is None:
        return catalog
    names = {c: rules.base_name(c) for c in panel.columns}
    entries = dictionary.select(F.col("variable").alias("_variable"), F.col("description").alias("_text"))
    joined = catalog.withColumn("_variable", lookup(names, F.col("feature_name"))).join(entries, "_variable", "left")
    text = F.when(F.col("feature_role") == "feature", F.col("_text"))
    return joined.withColumn("description", F.coalesce(text, "description")).select(*CATALOG_SCHEMA.names)


def describe(df: DataFrame, key: str, dictionary: DataFrame, default: str, out: str = "description") -> DataFrame:
    """Add a description from a dictionary table, or the default text followed by the key."""
    entries = dictionary.select(F.col("variable").alias(key), F.col("description").alias(out))
    return df.join(entries, key, "left").withColumn(out, F.coalesce(out, F.format_string(default, F.col(key))))
