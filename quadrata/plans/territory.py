"""The 16-borough study: catalogue, source specifications and table contracts as fixed values."""

from __future__ import annotations

from quadrata.functions.entities import EntityCatalog
from quadrata.functions.text import Rule
from quadrata.plans.panel import FeatureRule, FeatureRules, PanelSpec
from quadrata.plans.sources import EventSpec, Labels, SnapshotSpec, SurveySpec
from quadrata.sources.discovery import Signature

# --- Fixed values: boroughs in id order, survey codes, spellings -------------------------------------------------

BOROUGHS = (
    "AZCAPOTZALCO", "ALVARO OBREGON", "BENITO JUAREZ", "COYOACAN", "CUAJIMALPA DE MORELOS", "CUAUHTEMOC",
    "GUSTAVO A MADERO", "IZTACALCO", "IZTAPALAPA", "LA MAGDALENA CONTRERAS", "MIGUEL HIDALGO", "MILPA ALTA",
    "TLAHUAC", "TLALPAN", "VENUSTIANO CARRANZA", "XOCHIMILCO",
)

SURVEY_CODES = {
    2: "AZCAPOTZALCO",
    3: "COYOACAN",
    4: "CUAJIMALPA DE MORELOS",
    5: "GUSTAVO A MADERO",
    6: "IZTACALCO",
    7: "IZTAPALAPA",
    8: "LA MAGDALENA CONTRERAS",
    9: "MILPA ALTA",
    10: "ALVARO OBREGON",
    11: "TLAHUAC",
    12: "TLALPAN",
    13: "XOCHIMILCO",
    14: "BENITO JUAREZ",
    15: "CUAUHTEMOC",
    16: "MIGUEL HIDALGO",
    17: "VENUSTIANO CARRANZA",
}

SPELLINGS = {
    "GUSTAVO A MADERO CDMX": "GUSTAVO A MADERO",
    "CUAJIMALPA": "CUAJIMALPA DE MORELOS",
    "MAGDALENA CONTRERAS": "LA MAGDALENA CONTRERAS",
}

CATALOG = EntityCatalog(
    keys=BOROUGHS,
    codes=SURVEY_CODES,
    aliases={**{key: key for key in BOROUGHS}, **SPELLINGS},
    affixes=("ALCALDIA", "DELEGACION"),
)

REGION_CODE, REGION_NAME = 9, "Ciudad De Mexico"

# --- Fixed values: months ---------------------------------------------------------------------------------------

MONTHS = {
    1: "enero", 2: "febrero", 3: "marzo", 4: "abril", 5: "mayo", 6: "junio", 7: "julio", 8: "agosto",
    9: "septiembre", 10: "octubre", 11: "noviembre", 12: "diciembre",
}
MONTH_NUMBERS = {**{name.upper(): number for number, name in MONTHS.items()}, "SETIEMBRE": 9}

# --- Fixed values: variables ------------------------------------------------------------------------------------

SOCIAL = ("mmip", "rei", "nbi", "ccevj", "cbdj", "csj", "ctelj", "cenj", "ett", "casi", "cassi", "cyt")
SOCIAL_FEATURES = tuple(f"{v}_wmean" for v in SOCIAL)

SUMMED = ("ba1_noeqsa", "ba8_nomerc", "ba8_noloca", "ba9_no_gua", "ba3_noeqed", "resid_ton", "alump_sum")
AVERAGED = (
    "p_porcelec", "r_valelect", "p_aguapot", "r_val_dren", "epr_pob", "r_epr_pob", "r_resd_ton", "alump_mean",
    "r_alump_su", "r_alump_mn", "s_ri_6", "c_ri_6",
)
SUM_COLUMNS = {("alump_sum_total" if v == "alump_sum" else f"{v}_sum"): v for v in SUMMED}
MEAN_COLUMNS = {f"{v}_avg": v for v in AVERAGED}

INFRA_ALIASES = {
    "mercados_total": "ba8_nomerc_sum",
    "locales_total": "ba8_noloca_sum",
    "iluminacion_total": "alump_sum_total",
    "iluminacion_promedio": "alump_mean_avg",
    "residuos_ton_total": "resid_ton_sum",
    "equipamiento_salud_total": "ba1_noeqsa_sum",
    "equipamiento_educativo_total": "ba3_noeqed_sum",
    "agua_potable_promedio": "p_aguapot_avg",
    "electricidad_promedio": "p_porcelec_avg",
    "drenaje_promedio": "r_val_dren_avg",
}
INFRA_FEATURES = tuple(INFRA_ALIASES)

SNAPSHOT_YEAR, SNAPSHOT_TIME = 2022, 202200
SNAPSHOT_LABEL = "static_snapshot_2022"
PROVENANCE = {
    "infraestructura_actualizacion_anio": SNAPSHOT_YEAR,
    "infraestructura_es_snapshot": True,
    "infraestructura_temporalidad": SNAPSHOT_LABEL,
    "infraestructura_uso_recomendado": "variable estructural contextual; no interpretar como medicion anual",
}

# --- Fixed values: event classes and the keywords that decide them ----------------------------------------------

CLASS_COLUMNS = {
    "ROBO_A_TRANSEUNTE": "robo_a_transeunte",
    "ROBO_A_NEGOCIO": "robo_a_negocio",
    "ROBO_A_CASA_HABITACION": "robo_a_casa_habitacion",
    "ROBO_DE_VEHICULO": "robo_de_vehiculo",
    "ROBO_DE_ACCESORIOS_AUTO": "robo_de_accesorios_auto",
    "ROBO_DEL_INTERIOR_DE_VEHICULO": "robo_del_interior_de_vehiculo",
}
OTHER_CLASS = "OTRO"
CLASS_RULES = (
    Rule(OTHER_CLASS, none_of=("ROBO",)),
    Rule("ROBO_DE_ACCESORIOS_AUTO", all_of=("ACCESORIO",), any_of=("AUTO", "VEHICULO")),
    Rule("ROBO_DEL_INTERIOR_DE_VEHICULO", all_of=("INTERIOR",), any_of=("VEHICULO", "AUTO")),
    Rule("ROBO_A_TRANSEUNTE", any_of=("TRANSEUNTE", "PASAJERO")),
    Rule("ROBO_A_NEGOCIO", any_of=("NEGOCIO",)),
    Rule("ROBO_A_CASA_HABITACION", any_of=("CASA HABITACION",)),
    Rule("ROBO_DE_VEHICULO", any_of=("VEHICULO",)),
)
YEARS = (2016, 2025)
LAT_RANGE, LON_RANGE = (19.0, 19.7), (-99.4, -98.8)

# --- Fixed values: result columns -------------------------------------------------------------------------------

TOTAL, FLAGGED, NOT_FLAGGED = "total_delitos_fgj", "total_robos_patrimoniales", "total_no_robos_patrimoniales"
SHARE = "share_robos_patrimoniales_sobre_total_delitos"
TARGET, LOG_TARGET = "target_robos_patrimoniales_total", "target_robos_log1p"
LABELS = Labels("alcaldia_key", "alcaldia_nombre", "alcaldia_id", "anio", "mes", "tiempo_id")

SIGNATURES = {
    "fgj": Signature(("anio_inicio", "delito"), ("alcaldia_hecho", "alcaldia_catalogo")),
    "pobreza": Signature(("mmip", "factor", "entidad", "municipio")),
    "infraestructura": Signature(("cve_col", "colonia", "alcaldia"), ("ba1_noeqsa", "alump_sum")),
}

SURVEY = SurveySpec(
    catalog=CATALOG,
    region="entidad",
    region_value=REGION_CODE,
    entity="municipio",
    weight="factor",
    values=SOCIAL,
    synonyms={"ano": "anio"},
    labels=LABELS,
    rows="n_registros_sociales",
    weight_sum="factor_sum",
)

SNAPSHOT = SnapshotSpec(
    catalog=CATALOG,
    entity="alcaldia",
    subarea="colonia",
    sums=SUM_COLUMNS,
    means=MEAN_COLUMNS,
    aliases=INFRA_ALIASES,
    constants=PROVENANCE,
    labels=LABELS,
    subarea_key="colonia_key",
    subarea_name="colonia_nombre",
    subarea_count="colonias_count",
)

EVENTS = EventSpec(
    catalog=CATALOG,
    rules=CLASS_RULES,
    default_class=OTHER_CLASS,
    class_columns=CLASS_COLUMNS,
    month_names=MONTH_NUMBERS,
    years=YEARS,
    lat_range=LAT_RANGE,
    lon_range=LON_RANGE,
    date="fecha_hecho",
    start_date="fecha_inicio",
    year="anio_hecho",
    month="mes_hecho",
    entity="alcaldia_hecho",
    fallback_entity="alcaldia_catalogo",
    text="delito",
    category="categoria_delito",
    subarea="colonia_hecho",
    fallback_subarea="colonia_catalogo",
    lat="latitud",
    lon="longitud",
    clean_year="anio_hecho_clean",
    clean_month="mes_hecho_clean",
    text_key="delito_key",
    subarea_key="colonia_key",
    event_class="subtipo_robo_patrimonial",
    flag="is_robo_patrimonial",
    labels=LABELS,
)

PANEL = PanelSpec(
    key="alcaldia_key",
    year="anio",
    total=TOTAL,
    target=TARGET,
    log=LOG_TARGET,
    parts=tuple(CLASS_COLUMNS.values()),
    target_share=SHARE,
    features=INFRA_FEATURES,
    constants=PROVENANCE,
    preferred=(2016, 2018, 2020),
    extra=("colonias_count",),
)

CONTROLS = (
    TOTAL, "n_registros_sociales", "factor_sum", "infraestructura_actualizacion_anio",
    "infraestructura_es_snapshot", "infraestructura_temporalidad",
)
DERIVED = (SHARE, *[f"share_{c}" for c in CLASS_COLUMNS.values()])
MODEL_COLUMNS = (
    "alcaldia_id", "tiempo_id", "alcaldia_key", "alcaldia_nombre", "anio", TARGET, LOG_TARGET, *DERIVED,
    *SOCIAL_FEATURES, *INFRA_FEATURES, *CONTROLS,
)

ROBBERY = "fgj_robos_patrimoniales"
CONTROL_TEXT = "Variable de control, trazabilidad o cobertura del panel."
ID_TEXT = "Identificador o llave de la unidad alcaldia-anio."

FEATURE_RULES = FeatureRules(
    rules=(
        FeatureRule(
            lambda c: c == TARGET, "target", ROBBERY,
            "Target principal: total anual de robos patrimoniales clasificados.", "target", False, "annual",
            "No usar como feature; es la variable objetivo.",
        ),
        FeatureRule(
            lambda c: c == LOG_TARGET, "target", ROBBERY,
            "Transformacion log1p del target principal para analisis exploratorio.", "target", False, "annual",
            "Usar solo como target alternativo, no como predictor.",
        ),
        FeatureRule(
            lambda c: c in DERIVED, "derived_analysis", ROBBERY,
            "Proporcion derivada de conteos delictivos del mismo anio.", "high_same_year_target_derived", False,
            "annual", "Variable analitica; no recomendada como predictor por fuga de informacion.",
        ),
        FeatureRule(lambda c: c == "anio", "id", "etl", ID_TEXT, "none", False, "annual"),
        FeatureRule(
            lambda c: c in ("alcaldia_id", "tiempo_id", "alcaldia_key", "alcaldia_nombre"), "id", "etl", ID_TEXT,
            "none", False, "metadata",
        ),
        FeatureRule(
            lambda c: c in SOCIAL_FEATURES, "feature", "pobreza_mmip", "Promedio ponderado por factor de {name}.",
            "low", True, "annual",
        ),
        FeatureRule(
            lambda c: c in INFRA_FEATURES, "feature", "infraestructura",
            f"Indicador urbano agregado por alcaldia desde snapshot {SNAPSHOT_YEAR}.", "low", True, SNAPSHOT_LABEL,
        ),
        FeatureRule(
            lambda c: c == TOTAL, "control", "fuente", CONTROL_TEXT, "medium_same_year_control", False, "annual",
            "Control exploratorio del mismo anio; revisar uso en modelos predictivos.",
        ),
        FeatureRule(
            lambda c: c in CONTROLS and c.startswith("infraestructura_"), "metadata", "infraestructura",
            CONTROL_TEXT, "low", True, SNAPSHOT_LABEL,
        ),
        FeatureRule(lambda c: c in CONTROLS, "control", "fuente", CONTROL_TEXT, "low", True, "annual"),
    ),
    default=FeatureRule(
        lambda c: True, "metadata", "etl", "Variable auxiliar generada por el ETL.", "review", False, "metadata"
    ),
    base_name=lambda c: c.removesuffix("_wmean"),
)

# --- Fixed values: dimension rows -------------------------------------------------------------------------------

SOURCE_IDS = {
    "pobreza_mmip": 1,
    "infraestructura": 2,
    "fgj_general": 3,
    "fgj_robos_patrimoniales": 4,
    "panel_integrado_etl": 5,
}

SUBTYPE_TEXT = (
    "Robo a transeunte o pasajero clasificado desde delito.",
    "Robo a negocio clasificado desde delito.",
    "Robo a casa habitacion clasificado desde delito.",
    "Robo de vehiculo clasificado desde delito.",
    "Robo de accesorios de auto clasificado desde delito.",
    "Robo de objetos del interior de vehiculo.",
)

INFRA_VARIABLES = (
    "ba1_noeqsa_sum", "ba8_nomerc_sum", "ba8_noloca_sum", "ba9_no_gua_sum", "ba3_noeqed_sum", "resid_ton_sum",
    "alump_sum_total", "alump_mean_avg", "p_porcelec_avg", "p_aguapot_avg", "r_val_dren_avg", *INFRA_FEATURES,
)

SOURCE_ROWS = (
    (
        "Pobreza ENIGH MMIP", "csv", "datasets/enigh_16_20.csv", "datasets",
        "2016, 2018, 2020 si estan disponibles", "persona u hogar", "alcaldia-anio",
        "Promedios ponderados por factor.",
    ),
    (
        "Infraestructura urbana", "csv", "datasets/infraestructura.csv", "datasets", "snapshot 2022", "colonia",
        "colonia y alcaldia", PROVENANCE["infraestructura_uso_recomendado"],
    ),
    (
        "FGJ delitos generales", "csv", "datasets/carpetasFGJ_acumulado_2025_01.csv", "datasets", "2016-2025",
        "carpeta de investigacion", "alcaldia-anio", "Control anual de delitos generales FGJ.",
    ),
    (
        "FGJ robos patrimoniales", "csv derivado",
        "data/processed/robbery_only/fgj_robos_patrimoniales_clean.csv", "data/processed/robbery_only",
        "2016-2025", "carpeta de investigacion", "alcaldia-mes-subtipo y alcaldia-anio",
        "Solo seis subtipos patrimoniales; no incluye OTRO.",
    ),
    (
        "Panel integrado ETL", "derivado", "data/processed/analytics/panel_alcaldia_anio.csv",
        "data/processed/analytics", "anios comunes entre pobreza y FGJ", "alcaldia-anio", "alcaldia-anio",
        "No afirma causalidad; usar para exploracion, BI y modelos base.",
    ),
)

# --- Fixed values: features of the cluster analysis -------------------------------------------------------------

CLUSTER_FEATURES = (TARGET, "nbi_wmean", "iluminacion_promedio", "residuos_ton_total", "mercados_total")
EPS_VALUES = (0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0, 2.2)
OLS_FEATURES = ("iluminacion_promedio", "nbi_wmean", "rei_wmean", "drenaje_promedio")
