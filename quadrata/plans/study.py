"""The whole borough study on one session: clean, aggregate, panel, star schema, checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrata.operators import quality as q
from quadrata.operators.aggregates import null_report
from quadrata.operators.schema import conform
from quadrata.plans import contracts as c
from quadrata.plans import sources as s
from quadrata.plans import star
from quadrata.plans import territory as t
from quadrata.plans.panel import build_panel, feature_catalog, modeling_panel
from quadrata.sources.discovery import discover_sources, list_csv, missing_classes
from quadrata.sources.layers import land, read_csv, write_layer

TIME_NAMES = {
    "year": "anio", "month": "mes", "month_name": "mes_nombre", "quarter": "trimestre",
    "granularity": "granularidad",
}


@dataclass(frozen=True)
class Study:
    clean: Mapping[str, DataFrame]
    analytics: Mapping[str, DataFrame]
    star: Mapping[str, DataFrame]
    rejects: DataFrame


def read_sources(spark: SparkSession, folder: str, landing: str) -> dict[str, DataFrame]:
    """Find the three sources of a folder by their headers and land each once as Parquet."""
    found = discover_sources(list_csv(spark, folder), t.SIGNATURES)
    missing = missing_classes(found, list(t.SIGNATURES))
    if missing:
        raise FileNotFoundError(f"sources not found: {missing}")
    return {
        r.source_class: land(read_csv(spark, r.path), f"{landing}/{r.source_class}") for r in found.collect()
    }  # one row per class


def build_dimensions(spark: SparkSession, snapshot_clean: DataFrame, timed: list[DataFrame], dictionary: Mapping[str, str] | None = None, files: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The seven dimensions. ``dictionary`` overrides variable texts, ``files`` the detected source files."""
    dictionary, files = dictionary or {}, files or {}
    code_of = {key: code for code, key in t.SURVEY_CODES.items()}
    classes = list(t.CLASS_COLUMNS)
    origin = {**t.SUM_COLUMNS, **t.MEAN_COLUMNS}

    def infra_row(i: int, name: str) -> tuple:
        output = t.INFRA_ALIASES.get(name, name)
        method = "suma" if output in t.SUM_COLUMNS else "promedio"
        text = f"Indicador de infraestructura {name} desde snapshot 2022."
        return (i, name, origin[output], text, method, t.SNAPSHOT_YEAR, t.SNAPSHOT_LABEL, name in t.INFRA_FEATURES)

    def source_row(i: int, row: tuple) -> tuple:
        detected = {1: "pobreza", 2: "infraestructura", 3: "fgj"}.get(i)
        return (i, *row[:2], files.get(detected, row[2]), *row[3:])

    rows = {
        "dim_alcaldia": [
            (i, key, key.title(), code_of[key], t.REGION_CODE, t.REGION_NAME) for i, key in enumerate(t.BOROUGHS, 1)
        ],
        "dim_delito_subtipo": [
            (i, name, text, True) for i, (name, text) in enumerate(zip(classes, t.SUBTYPE_TEXT, strict=True), 1)
        ],
        "dim_variable_social": [
            (
                i, f"{v}_wmean", v, dictionary.get(v) or f"Variable social {v} agregada por promedio ponderado.",
                "promedio ponderado por factor", "revisar segun diccionario MMIP", True,
            )
            for i, v in enumerate(t.SOCIAL, 1)
        ],
        "dim_variable_infraestructura": [infra_row(i, name) for i, name in enumerate(t.INFRA_VARIABLES, 1)],
        "dim_fuente_datos": [source_row(i, row) for i, row in enumerate(t.SOURCE_ROWS, 1)],
    }
    dims = {name: star.dim_static(spark, data, c.DIMENSIONS[name]) for name, data in rows.items()}
    natural = ["alcaldia_id", "colonia_key", "colonia_nombre", "cve_col"]
    dims["dim_colonia"] = conform(
        star.dim_natural(
            snapshot_clean, natural, ["alcaldia_id", "colonia_key"], ["alcaldia_id", "colonia_key", "cve_col"], "colonia_id"
        ),
        c.DIMENSIONS["dim_colonia"],
    )
    dims["dim_tiempo"] = star.dim_time(timed, "tiempo_id", t.MONTHS, [t.SNAPSHOT_TIME], "anio", TIME_NAMES)
    return dims


def build_facts(dims: Mapping[str, DataFrame], analytics: Mapping[str, DataFrame], snapshot_clean: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    source = {name: {"fuente_datos_id": i} for name, i in t.SOURCE_IDS.items()}
    snapshot = {"snapshot_tiempo_id": t.SNAPSHOT_TIME, **source["infraestructura"]}
    subtypes = dims["dim_delito_subtipo"].select("subtipo_robo_patrimonial", "delito_subtipo_id")
    inputs = {
        "fact_delitos_generales_alcaldia_anio": (analytics["delitos_alcaldia_anio"], source["fgj_general"]),
        "fact_robos_patrimoniales_alcaldia_mes_subtipo": (
            star.fact_by_member(
                analytics["robos_patrimoniales_alcaldia_mes_subtipo"], subtypes, "subtipo_robo_patrimonial"
            ),
            source["fgj_robos_patrimoniales"],
        ),
        "fact_robos_patrimoniales_alcaldia_anio": (
            analytics["robos_patrimoniales_alcaldia_anio"],
            source["fgj_robos_patrimoniales"],
        ),
        "fact_pobreza_alcaldia_anio": (analytics["pobreza_alcaldia_anio"], source["pobreza_mmip"]),
        "fact_infraestructura_alcaldia": (analytics["infraestructura_alcaldia"], snapshot),
        "fact_infraestructura_colonia": (
            star.fact_by_natural_key(
                snapshot_clean, dims["dim_colonia"], ["alcaldia_id", "colonia_key", "cve_col"], "colonia_id"
            ),
            snapshot,
        ),
        "fact_panel_analitico_alcaldia_anio": (panel, source["panel_integrado_etl"]),
    }
    return {name: star.fact_conformed(df, c.FACTS[name], constants) for name, (df, constants) in inputs.items()}


def run_study(
    spark: SparkSession, survey: DataFrame, snapshot: DataFrame, events: DataFrame, out: str | None = None
) -> Study:
    """All layers from the three raw sources.

    With ``out`` the layers are written as Parquet: the clean event layer, partitioned by year, is written once
    (its reject counters come from the same pass) and the aggregates read it back. Without it everything stays
    a lazy plan.
    """
    derived, seen = s.derive_events(events, t.EVENTS), Observation()
    rejects = s.reject_counters(derived, t.EVENTS)
    if out:
        derived = s.observe_rejects(derived, t.EVENTS, seen)
    clean = {
        "pobreza_clean": s.clean_survey(survey, t.SURVEY),
        "infraestructura_clean": s.clean_snapshot(snapshot, t.SNAPSHOT),
        "fgj_clean": s.valid_events(derived, t.EVENTS),
    }
    if out:
        for name, df in clean.items():
            write_layer(df, f"{out}/clean/{name}", partition_by=["anio_hecho_clean"] if name == "fgj_clean" else ())
        clean = {name: spark.read.parquet(f"{out}/clean/{name}") for name in clean}
        rejects = spark.createDataFrame([tuple(seen.get.values())], [*seen.get])
    clean["fgj_robos_patrimoniales_clean"] = s.flagged_events(clean["fgj_clean"], t.EVENTS)

    analytics = {
        "pobreza_alcaldia_anio": s.aggregate_survey(clean["pobreza_clean"], t.SURVEY),
        "infraestructura_alcaldia": s.aggregate_snapshot(clean["infraestructura_clean"], t.SNAPSHOT),
        "delitos_alcaldia_anio": s.events_by_year(
            clean["fgj_clean"], t.EVENTS, t.TOTAL, t.FLAGGED, t.NOT_FLAGGED, t.SHARE
        ),
        "robos_patrimoniales_alcaldia_mes_subtipo": s.events_by_month_class(
            clean["fgj_clean"], t.EVENTS, t.FLAGGED, "registros_con_coordenadas", "latitud_promedio", "longitud_promedio"
        ),
        "robos_patrimoniales_alcaldia_anio": s.events_wide(clean["fgj_clean"], t.EVENTS, t.TARGET, t.LOG_TARGET),
    }
    if out:
        for name, df in analytics.items():
            write_layer(df, f"{out}/analytics/{name}")
        analytics = {name: spark.read.parquet(f"{out}/analytics/{name}") for name in analytics}

    panel = build_panel(
        analytics["pobreza_alcaldia_anio"],
        analytics["delitos_alcaldia_anio"],
        analytics["robos_patrimoniales_alcaldia_anio"],
        analytics["infraestructura_alcaldia"],
        t.PANEL,
    )
    model = modeling_panel(panel, t.MODEL_COLUMNS)
    analytics |= {
        "panel_alcaldia_anio": panel,
        "modeling_panel": model,
        "feature_catalog": feature_catalog(model, t.FEATURE_RULES),
        "modeling_panel_nulls": null_report(model),
    }
    timed = [
        analytics[n]
        for n in (
            "pobreza_alcaldia_anio", "delitos_alcaldia_anio", "robos_patrimoniales_alcaldia_mes_subtipo",
            "robos_patrimoniales_alcaldia_anio", "panel_alcaldia_anio",
        )
    ]
    dims = build_dimensions(spark, clean["infraestructura_clean"], timed)
    tables = {**dims, **build_facts(dims, analytics, clean["infraestructura_clean"], panel)}
    if out:
        for name, df in tables.items():
            write_layer(df, f"{out}/dw/{name}")
        tables = {name: spark.read.parquet(f"{out}/dw/{name}") for name in tables}
    return Study(clean, analytics, tables, rejects)


def checks(study: Study) -> DataFrame:
    """The validation report of a study, one row per check."""
    spark = study.rejects.sparkSession
    tables, analytics, clean = study.star, study.analytics, study.clean
    boroughs = spark.createDataFrame([(b,) for b in t.BOROUGHS], "alcaldia_key string")
    classes = spark.createDataFrame([(n,) for n in t.CLASS_COLUMNS], "subtipo_robo_patrimonial string")
    annual = tables["fact_robos_patrimoniales_alcaldia_anio"]
    reports = [
        q.row_checks(
            clean["fgj_clean"],
            {
                "fgj_clean.years": q.out_of_range("anio_hecho_clean", *t.YEARS),
                "fgj_clean.entities": ~t.CATALOG.contains("alcaldia_key"),
            },
        ),
        q.row_checks(
            clean["fgj_clean"],
            {"fgj_clean.coordinates": q.outside_box("latitud", "longitud", t.LAT_RANGE, t.LON_RANGE)},
            q.WARNING,
        ),
        q.row_checks(
            clean["fgj_robos_patrimoniales_clean"],
            {
                "flagged.years": q.out_of_range("anio_hecho_clean", *t.YEARS),
                "flagged.flag": q.not_constant("is_robo_patrimonial", 1),
                "flagged.excluded": F.col("subtipo_robo_patrimonial") == t.OTHER_CLASS,
            },
        ),
        q.cardinality_check(tables["dim_alcaldia"], len(t.BOROUGHS), "dim_alcaldia.count"),
        q.set_check(tables["dim_alcaldia"].select("alcaldia_key"), boroughs, "dim_alcaldia.catalog"),
        q.row_checks(tables["dim_alcaldia"], {"dim_alcaldia.id": F.col("alcaldia_id").isNull()}),
        q.cardinality_check(tables["dim_delito_subtipo"], len(t.CLASS_COLUMNS), "dim_delito_subtipo.count"),
        q.set_check(
            tables["dim_delito_subtipo"].select("subtipo_robo_patrimonial"), classes, "dim_delito_subtipo.catalog"
        ),
        q.row_checks(
            analytics["robos_patrimoniales_alcaldia_mes_subtipo"],
            {"monthly.excluded": F.col("subtipo_robo_patrimonial") == t.OTHER_CLASS},
        ),
        q.row_checks(
            annual,
            {
                "annual.target": F.col(t.TARGET).isNull(),
                "annual.conserved": q.not_conserved(t.TARGET, list(t.CLASS_COLUMNS.values())),
            },
        ),
        q.forbidden_name_check(annual, t.OTHER_CLASS, "annual.excluded_column"),
        *[
            q.row_checks(
                tables[name],
                {
                    f"{name}.time": q.not_constant("snapshot_tiempo_id", t.SNAPSHOT_TIME),
                    f"{name}.year": q.not_constant("infraestructura_actualizacion_anio", t.SNAPSHOT_YEAR),
                    f"{name}.flag": q.not_constant("infraestructura_es_snapshot", True),
                    f"{name}.label": q.not_constant("infraestructura_temporalidad", t.SNAPSHOT_LABEL),
                },
            )
            for name in ("fact_infraestructura_alcaldia", "fact_infraestructura_colonia")
        ],
        q.key_checks(
            tables,
            [
                *[q.UniqueKey(f"{n}.primary_key", n, (contract.names[0],)) for n, contract in c.DIMENSIONS.items()],
                *[q.UniqueKey(f"{n}.natural_key", n, tuple(keys)) for n, keys in c.NATURAL_KEYS.items()],
                *[q.UniqueKey(f"{n}.grain", n, tuple(keys)) for n, keys in c.GRAINS.items()],
                *[q.ForeignKey(f"{r.table}.{r.column}", r.table, r.column, r.dim, r.dim_column) for r in c.REFERENCES],
            ],
        ),
        q.balance_check(
            tables["fact_panel_analitico_alcaldia_anio"], "anio", "alcaldia_id", len(t.BOROUGHS), "panel.balanced"
        ),
        *[
            q.domain_check(df, "alcaldia_key", t.BOROUGHS, f"{name}.entities")
            for name, df in (
                ("panel", analytics["panel_alcaldia_anio"]),
                ("modeling", analytics["modeling_panel"]),
                ("fact_panel", tables["fact_panel_analitico_alcaldia_anio"]),
            )
        ],
        q.catalog_checks(
            analytics["feature_catalog"],
            ["id", "target", "feature", "control", "derived_analysis"],
            t.INFRA_FEATURES,
            t.SNAPSHOT_LABEL,
        ),
        q.row_checks(
            analytics["modeling_panel_nulls"], {"modeling_panel.nulls": F.col("null_count") > 0}, q.WARNING
        ),
        q.no_empty_column_check(analytics["panel_alcaldia_anio"], "panel.empty_columns"),
        *[q.schema_checks(tables[n], contract, n) for n, contract in {**c.DIMENSIONS, **c.FACTS}.items()],
    ]
    return q.stack(reports)
