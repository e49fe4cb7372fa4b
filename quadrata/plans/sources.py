"""Cleaning and aggregation of the three kinds of source: weighted survey, static snapshot, event records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quadrata.functions.dates import iso_date, month_of_key, time_id, with_dates
from quadrata.functions.entities import EntityCatalog
from quadrata.functions.names import normalize_columns, rename_if_absent
from quadrata.functions.numeric import coerce_numeric, inside_box, stamp, try_double
from quadrata.functions.text import (
    Rule,
    classify_rules,
    flag_in,
    pin,
    title_label,
    trim_strings,
    with_text_keys,
)
from quadrata.operators.aggregates import (
    counters,
    counts_with_complement,
    located_counts,
    snapshot_rollup,
    weighted_means,
    wide_counts,
)


@dataclass(frozen=True)
class Labels:
    """Names of the shared output columns."""

    key: str = "entity_key"
    name: str = "entity_name"
    id: str = "entity_id"
    year: str = "year"
    month: str = "month"
    time: str = "time_id"

    def entity(self) -> list[str]:
        return [self.key, self.name, self.id]


def add_entity_fields(df: DataFrame, source: str, catalog: EntityCatalog, labels: Labels) -> DataFrame:
    """Canonical key, display name and id of the entity named or coded in a column."""
    keyed = pin(catalog.with_canonical(df, labels.key, source), labels.key)
    return keyed.withColumns({labels.name: catalog.name(labels.key), labels.id: catalog.id(labels.key)})


@dataclass(frozen=True)
class SurveySpec:
    catalog: EntityCatalog
    region: str
    region_value: int
    entity: str
    weight: str
    values: tuple[str, ...]
    synonyms: Mapping[str, str] = field(default_factory=dict)
    labels: Labels = Labels()
    rows: str = "n_rows"
    weight_sum: str = "weight_sum"


def clean_survey(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Rows of the region with a catalogued entity and a year, numbers cast, annual time key added."""
    labels = spec.labels
    df = normalize_columns(df)
    for old, new in spec.synonyms.items():
        df = rename_if_absent(df, old, new)
    numbers = [spec.region, spec.entity, labels.year, spec.weight, *spec.values]
    df = coerce_numeric(trim_strings(df), numbers).where(F.col(spec.region) == spec.region_value)
    df = add_entity_fields(df, spec.entity, spec.catalog, labels)
    return (
        df.where(F.col(labels.key).isNotNull() & F.col(labels.year).isNotNull())
        .withColumn(labels.year, F.col(labels.year).cast("int"))
        .withColumn(labels.time, time_id(labels.year))
    )


def aggregate_survey(clean: DataFrame, spec: SurveySpec) -> DataFrame:
    labels = spec.labels
    means = weighted_means(
        clean, [labels.key, labels.name, labels.year], spec.values, spec.weight, spec.rows, spec.weight_sum
    )
    return means.select(
        labels.key,
        labels.name,
        spec.catalog.id(labels.key).alias(labels.id),
        labels.year,
        time_id(labels.year).alias(labels.time),
        spec.rows,
        spec.weight_sum,
        *[f"{v}_wmean" for v in spec.values],
    )


@dataclass(frozen=True)
class SnapshotSpec:
    catalog: EntityCatalog
    entity: str
    subarea: str
    sums: Mapping[str, str]
    means: Mapping[str, str]
    aliases: Mapping[str, str]
    constants: Mapping[str, object]
    labels: Labels = Labels()
    subarea_key: str = "subarea_key"
    subarea_name: str = "subarea_name"
    subarea_count: str = "subarea_count"


def clean_snapshot(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Rows of catalogued entities with sub-area key and label, provenance constants and cast numbers."""
    df = trim_strings(normalize_columns(df))
    df = add_entity_fields(df, spec.entity, spec.catalog, spec.labels)
    df = with_text_keys(df, {spec.subarea_key: spec.subarea})
    df = df.withColumn(spec.subarea_name, title_label(spec.subarea_key))
    df = coerce_numeric(stamp(df, spec.constants), [*spec.sums.values(), *spec.means.values()])
    return df.where(F.col(spec.labels.key).isNotNull())


def aggregate_snapshot(clean: DataFrame, spec: SnapshotSpec) -> DataFrame:
    return snapshot_rollup(
        clean, spec.labels.entity(), spec.subarea_key, spec.sums, spec.means, spec.aliases, spec.subarea_count, spec.constants
    )


@dataclass(frozen=True)
class EventSpec:
    """Input columns of event records. Columns the input lacks are taken as null."""

    catalog: EntityCatalog
    rules: Sequence[Rule]
    default_class: str
    class_columns: Mapping[str, str]
    month_names: Mapping[str, int]
    years: tuple[int, int]
    lat_range: tuple[float, float]
    lon_range: tuple[float, float]
    date: str
    start_date: str
    year: str
    month: str
    entity: str
    fallback_entity: str
    text: str
    category: str
    subarea: str
    fallback_subarea: str
    lat: str
    lon: str
    clean_year: str
    clean_month: str
    text_key: str
    subarea_key: str
    event_class: str
    flag: str
    labels: Labels = Labels()

    def inputs(self) -> list[str]:
        return [
            self.date, self.start_date, self.year, self.month, self.entity, self.fallback_entity, self.text,
            self.category, self.subarea, self.fallback_subarea, self.lat, self.lon,
        ]

    def clean_columns(self) -> list[str]:
        return [
            self.date, self.start_date, self.clean_year, self.clean_month, self.text, self.text_key, self.category,
            self.labels.key, self.labels.name, self.subarea_key, self.subarea, self.lat, self.lon,
            self.event_class, self.flag,
        ]


def _placed(df: DataFrame, spec: EventSpec) -> DataFrame:
    """All rows with entity, year and month, by which they are kept or not."""
    df = normalize_columns(df)
    absent = {c: F.lit(None).cast("string") for c in spec.inputs() if c not in df.columns}
    df = trim_strings(df.withColumns(absent).select(*spec.inputs()))
    df = with_dates(df, {"_date": spec.date})
    month = {"_month": F.when(F.col("_date").isNull(), F.col(spec.month))}
    df = spec.catalog.with_canonical(df, spec.labels.key, spec.entity, spec.fallback_entity, also=month)
    df = df.withColumns(
        {
            spec.clean_year: F.coalesce(try_double(spec.year), F.year("_date")),
            spec.clean_month: F.coalesce(F.month("_date"), month_of_key(F.col("_month"), spec.month_names)),
        }
    )
    return pin(df.drop("_month"), spec.labels.key, spec.clean_year, spec.clean_month)


def _described(placed: DataFrame, spec: EventSpec, keys: Mapping[str, str]) -> DataFrame:
    """The same rows with all other derived fields; ``keys`` are further text keys."""
    df = with_dates(placed, {"_start": spec.start_date})
    df = with_text_keys(df, {spec.text_key: spec.text, **keys})
    df = df.withColumns(
        {
            spec.date: iso_date("_date"),
            spec.start_date: iso_date("_start"),
            spec.lat: try_double(spec.lat),
            spec.lon: try_double(spec.lon),
            spec.labels.name: spec.catalog.name(spec.labels.key),
            spec.event_class: classify_rules(spec.text_key, spec.rules, spec.default_class),
        }
    )
    df = df.withColumn(spec.flag, flag_in(spec.event_class, spec.class_columns)).drop("_date", "_start")
    return pin(df, spec.event_class, spec.flag)


def derive_events(df: DataFrame, spec: EventSpec) -> DataFrame:
    """All rows with the derived fields, before any filter.

    The year is the numeric field, else the year of the date; the month is the month of the date, else the
    month text; the entity is the primary field, else the secondary one. Only fields of the specification
    are kept, so unused source columns are never read.
    """
    return _described(_placed(df, spec), spec, {})


def _period_tests(spec: EventSpec):
    month_ok = F.coalesce(F.col(spec.clean_month).between(1, 12), F.lit(False))
    readable = F.col(spec.clean_year).isNotNull() & month_ok
    inside = F.coalesce(F.col(spec.clean_year).between(*spec.years), F.lit(False)) & month_ok
    return readable, inside


def reject_conditions(spec: EventSpec) -> dict[str, Column]:
    """Independent conditions over all derived rows; a row may be rejected for several reasons."""
    readable, inside = _period_tests(spec)
    known = F.col(spec.labels.key).isNotNull()
    located = F.col(spec.lat).isNotNull() & F.col(spec.lon).isNotNull()
    in_box = inside_box(spec.lat, spec.lon, spec.lat_range, spec.lon_range)
    valid = known & inside
    return {
        "original_rows": F.lit(True),
        "clean_rows": valid,
        "flagged_rows": valid & (F.col(spec.flag) == 1),
        "invalid_entity": ~known,
        "unreadable_period": ~readable,
        "outside_years": readable & ~inside,
        "with_coordinates": valid & located,
        "without_coordinates": valid & ~located,
        "outside_box": valid & located & ~in_box,
    }


def reject_counters(derived: DataFrame, spec: EventSpec) -> DataFrame:
    """All counters as one row, from one pass."""
    return counters(derived, reject_conditions(spec))


def observe_rejects(derived: DataFrame, spec: EventSpec, observation: Observation) -> DataFrame:
    """The same rows; whatever action runs on them also fills the counters of the observation."""
    return derived.observe(observation, *[F.count_if(c).alias(n) for n, c in reject_conditions(spec).items()])


def _kept(placed: DataFrame, spec: EventSpec) -> DataFrame:
    """Rows of a catalogued entity and a period inside the range."""
    _, inside = _period_tests(spec)
    return placed.where(F.col(spec.labels.key).isNotNull() & inside).withColumns(
        {
            spec.clean_year: F.col(spec.clean_year).cast("int"),
            spec.clean_month: F.col(spec.clean_month).cast("int"),
            spec.subarea: F.coalesce(spec.subarea, spec.fallback_subarea),
        }
    )


def valid_events(derived: DataFrame, spec: EventSpec) -> DataFrame:
    """Rows of a catalogued entity and a period inside the range, projected to the clean contract."""
    return with_text_keys(_kept(derived, spec), {spec.subarea_key: spec.subarea}).select(*spec.clean_columns())


def clean_events(df: DataFrame, spec: EventSpec) -> DataFrame:
    """The valid events of raw records; fields that do not decide on a row are only derived for the rows that stay."""
    kept = _kept(_placed(df, spec), spec)
    return _described(kept, spec, {spec.subarea_key: spec.subarea}).select(*spec.clean_columns())


def flagged_events(clean: DataFrame, spec: EventSpec) -> DataFrame:
    return clean.where(F.col(spec.flag) == 1)


def _dated(df: DataFrame, spec: EventSpec) -> DataFrame:
    labels = spec.labels
    return df.withColumnsRenamed({spec.clean_year: labels.year, spec.clean_month: labels.month})


def events_by_year(clean: DataFrame, spec: EventSpec, total: str, flagged: str, complement: str, share: str) -> DataFrame:
    """Events, flagged events, complement and share per entity and year."""
    labels = spec.labels
    counted = counts_with_complement(
        _dated(clean, spec), [labels.key, labels.name, labels.year], total, flagged, complement, share, flag=spec.flag
    )
    return counted.select(
        labels.key,
        labels.name,
        spec.catalog.id(labels.key).alias(labels.id),
        labels.year,
        time_id(labels.year).alias(labels.time),
        total,
        flagged,
        complement,
        share,
    )


def events_by_month_class(
    clean: DataFrame, spec: EventSpec, rows: str, located: str, mean_lat: str, mean_lon: str
) -> DataFrame:
    """Flagged events, located ones and mean coordinates per entity, month and class."""
    labels = spec.labels
    keys = [labels.key, labels.name, labels.year, labels.month, spec.event_class]
    counted = located_counts(
        _dated(flagged_events(clean, spec), spec), keys, spec.lat, spec.lon, rows, located, mean_lat, mean_lon
    )
    return counted.select(
        labels.key,
        labels.name,
        spec.catalog.id(labels.key).alias(labels.id),
        labels.year,
        labels.month,
        time_id(labels.year, F.col(labels.month)).alias(labels.time),
        spec.event_class,
        rows,
        located,
        mean_lat,
        mean_lon,
    )


def events_wide(clean: DataFrame, spec: EventSpec, total: str, log: str) -> DataFrame:
    """Flagged events per entity and year with one column per class."""
    labels = spec.labels
    counted = wide_counts(
        _dated(flagged_events(clean, spec), spec),
        [labels.key, labels.name, labels.year],
        spec.event_class,
        spec.class_columns,
        total,
        log,
    )
    return counted.select(
        labels.key,
        labels.name,
        spec.catalog.id(labels.key).alias(labels.id),
        labels.year,
        time_id(labels.year).alias(labels.time),
        total,
        *spec.class_columns.values(),
        log,
    )
