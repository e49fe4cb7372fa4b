"""Table contracts of the borough study: columns, types, keys. Spark enforces no keys; the checks do."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from quadrata.plans import territory as t

_INT, _LONG, _DBL, _STR, _BOOL = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()

# Types by column name; anything not listed here is text if it is in _TEXT, else double.
_INTS = {
    "anio", "mes", "trimestre", "municipio_enigh", "cve_ent", "tiempo_id", "snapshot_tiempo_id", "alcaldia_id",
    "colonia_id", "delito_subtipo_id", "fuente_datos_id", "variable_social_id", "variable_infraestructura_id",
    "anio_hecho_clean", "mes_hecho_clean", "is_robo_patrimonial", "infraestructura_actualizacion_anio",
    "actualizacion_anio",
}
_LONGS = {
    t.TOTAL, t.FLAGGED, t.NOT_FLAGGED, t.TARGET, *t.CLASS_COLUMNS.values(), "n_registros_sociales",
    "registros_con_coordenadas", "colonias_count",
}
_BOOLS = {"infraestructura_es_snapshot", "es_robo_patrimonial", "recomendada_modelado", "recommended_for_modeling"}
_TEXT = {
    "fecha_hecho", "fecha_inicio", "delito", "delito_key", "categoria_delito", "alcaldia_key", "alcaldia_nombre",
    "colonia_key", "colonia_hecho", "colonia_nombre", "cve_col", "subtipo_robo_patrimonial", "descripcion",
    "infraestructura_temporalidad", "infraestructura_uso_recomendado", "entidad_nombre", "mes_nombre",
    "granularidad", "variable_nombre", "variable_origen", "metodo_agregacion", "rango_esperado", "temporalidad",
    "fuente_nombre", "fuente_tipo", "archivo_origen", "carpeta_origen", "cobertura_temporal",
    "granularidad_original", "granularidad_final", "notas_uso", "feature_name", "source_dataset", "feature_role",
    "data_type", "description", "leakage_risk", "temporal_behavior", "notes",
}


def schema(*names: str) -> T.StructType:
    def kind(name: str) -> T.DataType:
        groups = ((_INTS, _INT), (_LONGS, _LONG), (_BOOLS, _BOOL), (_TEXT, _STR))
        return next((kind for names, kind in groups if name in names), _DBL)

    return T.StructType([T.StructField(n, kind(n)) for n in names])


_ENTITY = ("alcaldia_key", "alcaldia_nombre", "alcaldia_id")
_ANNUAL = (*_ENTITY, "anio", "tiempo_id")
_SNAPSHOT = ("infraestructura_actualizacion_anio", "infraestructura_es_snapshot", "infraestructura_temporalidad")
_FACT_SUMS = tuple(t.SUM_COLUMNS)
_FACT_MEANS = ("alump_mean_avg", "p_porcelec_avg", "p_aguapot_avg", "r_val_dren_avg")
_FACT_RAW = (*t.SUMMED, "alump_mean", "p_porcelec", "p_aguapot", "r_val_dren")
_CLASSES = tuple(t.CLASS_COLUMNS.values())

ANALYTICS = {
    "pobreza_alcaldia_anio": schema(*_ANNUAL, "n_registros_sociales", "factor_sum", *t.SOCIAL_FEATURES),
    "infraestructura_alcaldia": schema(
        *_ENTITY, "colonias_count", *t.PROVENANCE, *t.SUM_COLUMNS, *t.MEAN_COLUMNS, *t.INFRA_FEATURES
    ),
    "delitos_alcaldia_anio": schema(*_ANNUAL, t.TOTAL, t.FLAGGED, t.NOT_FLAGGED, t.SHARE),
    "robos_patrimoniales_alcaldia_mes_subtipo": schema(
        *_ENTITY, "anio", "mes", "tiempo_id", "subtipo_robo_patrimonial", t.FLAGGED, "registros_con_coordenadas",
        "latitud_promedio", "longitud_promedio",
    ),
    "robos_patrimoniales_alcaldia_anio": schema(*_ANNUAL, t.TARGET, *_CLASSES, t.LOG_TARGET),
    "modeling_panel": schema(*t.MODEL_COLUMNS),
}

DIMENSIONS = {
    "dim_alcaldia": schema(
        "alcaldia_id", "alcaldia_key", "alcaldia_nombre", "municipio_enigh", "cve_ent", "entidad_nombre"
    ),
    "dim_tiempo": schema("tiempo_id", "anio", "mes", "mes_nombre", "trimestre", "granularidad"),
    "dim_colonia": schema("colonia_id", "alcaldia_id", "colonia_key", "colonia_nombre", "cve_col"),
    "dim_delito_subtipo": schema(
        "delito_subtipo_id", "subtipo_robo_patrimonial", "descripcion", "es_robo_patrimonial"
    ),
    "dim_variable_social": schema(
        "variable_social_id", "variable_nombre", "variable_origen", "descripcion", "metodo_agregacion",
        "rango_esperado", "recomendada_modelado",
    ),
    "dim_variable_infraestructura": schema(
        "variable_infraestructura_id", "variable_nombre", "variable_origen", "descripcion", "metodo_agregacion",
        "actualizacion_anio", "temporalidad", "recomendada_modelado",
    ),
    "dim_fuente_datos": schema(
        "fuente_datos_id", "fuente_nombre", "fuente_tipo", "archivo_origen", "carpeta_origen",
        "cobertura_temporal", "granularidad_original", "granularidad_final", "notas_uso",
    ),
}

FACTS = {
    "fact_delitos_generales_alcaldia_anio": schema(
        "alcaldia_id", "tiempo_id", "fuente_datos_id", t.TOTAL, t.FLAGGED, t.NOT_FLAGGED, t.SHARE
    ),
    "fact_robos_patrimoniales_alcaldia_mes_subtipo": schema(
        "alcaldia_id", "tiempo_id", "delito_subtipo_id", "fuente_datos_id", t.FLAGGED, "registros_con_coordenadas",
        "latitud_promedio", "longitud_promedio",
    ),
    "fact_robos_patrimoniales_alcaldia_anio": schema(
        "alcaldia_id", "tiempo_id", "fuente_datos_id", t.TARGET, *_CLASSES, t.LOG_TARGET
    ),
    "fact_pobreza_alcaldia_anio": schema(
        "alcaldia_id", "tiempo_id", "fuente_datos_id", "n_registros_sociales", "factor_sum", *t.SOCIAL_FEATURES
    ),
    "fact_infraestructura_alcaldia": schema(
        "alcaldia_id", "snapshot_tiempo_id", "fuente_datos_id", *_SNAPSHOT, "colonias_count", *_FACT_SUMS,
        *_FACT_MEANS,
    ),
    "fact_infraestructura_colonia": schema(
        "colonia_id", "alcaldia_id", "snapshot_tiempo_id", "fuente_datos_id", *_SNAPSHOT, "cve_col", *_FACT_RAW
    ),
    "fact_panel_analitico_alcaldia_anio": schema(
        "alcaldia_id", "tiempo_id", "fuente_datos_id", t.TARGET, t.LOG_TARGET, t.SHARE, t.TOTAL,
        "n_registros_sociales", "factor_sum", *t.SOCIAL_FEATURES, *t.INFRA_FEATURES, *_SNAPSHOT, "anio",
        "alcaldia_key", "alcaldia_nombre",
    ),
}


@dataclass(frozen=True)
class Reference:
    """A foreign key: fact column to dimension column."""

    table: str
    column: str
    dim: str
    dim_column: str


NATURAL_KEYS = {
    "dim_alcaldia": ("alcaldia_key",),
    "dim_tiempo": ("tiempo_id",),
    "dim_colonia": ("alcaldia_id", "colonia_key", "cve_col"),
    "dim_delito_subtipo": ("subtipo_robo_patrimonial",),
    "dim_variable_social": ("variable_nombre",),
    "dim_variable_infraestructura": ("variable_nombre",),
    "dim_fuente_datos": ("fuente_nombre",),
}


def _time_column(table: str) -> str:
    return "snapshot_tiempo_id" if "snapshot_tiempo_id" in FACTS[table].names else "tiempo_id"


def _grain(table: str) -> tuple[str, ...]:
    subject = "colonia_id" if "colonia_id" in FACTS[table].names else "alcaldia_id"
    extra = ("delito_subtipo_id",) if "delito_subtipo_id" in FACTS[table].names else ()
    return (subject, _time_column(table), *extra)


GRAINS = {table: _grain(table) for table in FACTS}

REFERENCES = (
    *[Reference(f, "alcaldia_id", "dim_alcaldia", "alcaldia_id") for f in FACTS],
    *[Reference(f, _time_column(f), "dim_tiempo", "tiempo_id") for f in FACTS],
    *[Reference(f, "fuente_datos_id", "dim_fuente_datos", "fuente_datos_id") for f in FACTS],
    Reference(
        "fact_robos_patrimoniales_alcaldia_mes_subtipo", "delito_subtipo_id", "dim_delito_subtipo",
        "delito_subtipo_id",
    ),
    Reference("fact_infraestructura_colonia", "colonia_id", "dim_colonia", "colonia_id"),
    Reference("dim_colonia", "alcaldia_id", "dim_alcaldia", "alcaldia_id"),
)
