"""The nation-by-year panel, its catalogue, and the dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrata.functions.dates import time_id
from quadrata.functions.text import lookup
from quadrata.operators import aggregates as ag
from quadrata.operators import olap
from quadrata.operators.learning import model_matrix
from quadrata.plans import star
from quadrata.plans.panel import FeatureRule, FeatureRules, PanelSpec, build_panel, feature_catalog, modeling_panel
from quadrata.plans.sources import SnapshotSpec, SurveySpec, aggregate_survey, clean_snapshot, clean_survey
from quadrata.plans.territory import MONTHS
from quadrata.session import cut_lineage, load, load_spread
from quadrata.workload.aggregates import (
    SUPPLIER_SQL,
    WEIGHTED_SQL,
    WEIGHTED_VALUES,
    snapshot_rollup,
    weighted_columns,
    weighted_mean,
    weighted_terms,
)
from quadrata.workload.base import (
    CLASSES,
    LABELS,
    LINES_SQL,
    NATIONS,
    OTHER,
    SNAPSHOT_TIME,
    SOURCE_IDS,
    flagged_line,
    on_lines,
    part_classes,
    query,
    rounded,
    sales,
    spanish_month_sql,
)
from quadrata.workload.scalars import located_sales

# --- Survey and snapshot sources ----------------------------------------------------------------------------------

SURVEY = SurveySpec(
    catalog=NATIONS,
    region="region_code",
    region_value=2,
    entity="municipality",
    weight="weight",
    values=("price", "tax"),
    synonyms={"ano": "year"},
    labels=LABELS,
)

_SURVEY_SQL = """s AS (SELECT 'NATION ' || c_nationkey AS entity_key, 'Nation ' || c_nationkey AS entity_name,
  c_nationkey + 1 AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(year(o_orderdate) * 100 AS INTEGER) AS time_id,
  CASE WHEN l_orderkey % 11 <> 0 THEN l_quantity END AS weight, l_extendedprice AS price,
  CASE WHEN l_linenumber <> 4 THEN l_tax END AS tax
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 AND l_orderkey % 13 <> 0)"""


def raw_survey(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as weighted survey rows, as text, with unreadable weights and years."""
    order = F.col("l_orderkey")
    rows = (
        load_spread(spark, folder, "lineitem")
        .join(load(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(load(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.concat(F.lit(" "), F.col("n_regionkey")).alias("Region Code"),
        F.col("c_nationkey").cast("string").alias("Municipality"),
        F.when(order % 13 == 0, "s/d").otherwise(F.year("o_orderdate").cast("string")).alias("Año"),
        F.when(order % 11 == 0, "x").otherwise(F.col("l_quantity").cast("string")).alias("weight"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_linenumber") != 4, F.col("l_tax").cast("string")).alias("tax"),
    )


@query(
    "survey_clean",
    f"WITH {_SURVEY_SQL} SELECT entity_key, entity_name, entity_id, year, time_id, weight, price, tax FROM s",
)
def survey_clean(spark: SparkSession, folder: str) -> DataFrame:
    clean = clean_survey(raw_survey(spark, folder), SURVEY)
    return clean.select("entity_key", "entity_name", "entity_id", "year", "time_id", "weight", "price", "tax")


@query(
    "survey_aggregate",
    f"""WITH {_SURVEY_SQL} SELECT entity_key, entity_name, entity_id, year, time_id, count(*) AS n_rows,
     coalesce(sum(weight), 0) AS weight_sum, {rounded("sum(price * weight) / sum(weight)", 4)} AS price_wmean,
     {rounded("sum(tax * weight) / nullif(sum(CASE WHEN tax IS NOT NULL THEN weight END), 0)")} AS tax_wmean
    FROM s GROUP BY ALL""",
)
def survey_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    means = aggregate_survey(clean_survey(raw_survey(spark, folder), SURVEY), SURVEY)
    return means.withColumns(
        {"price_wmean": F.round("price_wmean", 4) + 0.0, "tax_wmean": F.round("tax_wmean", 6) + 0.0}
    )


SNAPSHOT = SnapshotSpec(
    catalog=NATIONS,
    entity="s_nationkey",
    subarea="s_name",
    sums={},
    means={"balance_avg": "s_acctbal"},
    aliases={},
    constants={"snapshot_year": 1997, "is_snapshot": True, "snapshot_label": "static_1997"},
    labels=LABELS,
)


@query(
    "snapshot_clean",
    """SELECT s_suppkey, 'NATION ' || s_nationkey AS entity_key, 'Nation ' || s_nationkey AS entity_name,
      s_nationkey + 1 AS entity_id, upper(replace(s_name, '#', ' ')) AS subarea_key, replace(s_name, '#', ' ') AS subarea_name,
      s_acctbal, 1997 AS snapshot_year, true AS is_snapshot, 'static_1997' AS snapshot_label FROM supplier""",
)
def snapshot_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = load(spark, folder, "supplier").withColumn("s_acctbal", F.col("s_acctbal").cast("string"))
    return clean_snapshot(raw, SNAPSHOT).drop("s_name", "s_nationkey")


# --- Panel --------------------------------------------------------------------------------------------------------

PANEL = PanelSpec(
    key="nation",
    year="year",
    total="total_lines",
    target="target",
    log="target_log1p",
    parts=tuple(CLASSES.values()),
    target_share="share_target",
    features=("balance_total", "absent_total"),
    constants={"snapshot_year": 1997, "snapshot_label": "static_1997"},
    preferred=(1996, 1998, 2000),
    extra=("subarea_count",),
)


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Survey means, counts and classes come from one pass over the line items; the cells are few."""
    classed = part_classes(spark, folder)
    terms = {
        **weighted_terms(),
        **{name: F.when(F.col("class") == value, 1).otherwise(0) for value, name in CLASSES.items()},
    }
    cells = cut_lineage(
        sales(
            spark, folder, ["nation_id", "nation", "year"], terms,
            lines=lambda df: df.join(classed, F.col("l_partkey") == F.col("p_partkey")),
        )
    )
    keys = ["nation", "year"]
    base = cells.select(
        *keys,
        (F.col("nation_id") + 1).alias("entity_id"),
        time_id("year").alias("time_id"),
        *weighted_columns(),
    )
    general = cells.select(*keys, F.col("n_rows").alias("total_lines"))
    total = sum((F.col(n) for n in CLASSES.values()), F.lit(0))
    target = cells.select(*keys, total.cast("bigint").alias("target"), *CLASSES.values()).where("target > 0")
    return build_panel(base, general, target, snapshot_rollup(spark, folder), PANEL)


_PARTS = ", ".join(f"count(*) FILTER (WHERE class = '{v}') AS {n}" for v, n in CLASSES.items())
_FILLED = ", ".join(f"coalesce({n}, 0) AS {n}" for n in CLASSES.values())
_SHARES = ", ".join(f"CAST(coalesce({n}, 0) AS DOUBLE) / nullif(target, 0) AS share_{n}" for n in CLASSES.values())
PANEL_CTES = f""", w AS ({WEIGHTED_SQL}), g AS (SELECT nation, year, count(*) AS total_lines FROM ev GROUP BY nation, year),
 t AS (SELECT nation, year, count(*) AS target, {_PARTS} FROM ev WHERE class <> 'OTHER' GROUP BY nation, year),
 s AS ({SUPPLIER_SQL}), j AS (SELECT * FROM w LEFT JOIN g USING (nation, year) LEFT JOIN t USING (nation, year)
  LEFT JOIN s USING (nation) JOIN (SELECT n_name AS nation, n_nationkey FROM nation) USING (nation)
  WHERE year IN (1996, 1998, 2000)),
 p AS (SELECT nation, year, n_nationkey + 1 AS entity_id, year * 100 AS time_id, n_rows, weight_sum, price_wmean,
  discount_wmean, tax_wmean, total_lines, coalesce(target, 0) AS target, {_FILLED},
  {rounded("ln(1 + coalesce(target, 0))")} AS target_log1p,
  CAST(coalesce(target, 0) AS DOUBLE) / nullif(total_lines, 0) AS share_target, {_SHARES}, subarea_count,
  balance_total, absent_total, coalesce(snapshot_year, 1997) AS snapshot_year,
  coalesce(snapshot_label, 'static_1997') AS snapshot_label FROM j)"""


def rounded_log(df: DataFrame) -> DataFrame:
    return df.withColumn("target_log1p", F.round("target_log1p", 6))


@query("panel", on_lines("SELECT * FROM p", PANEL_CTES))
def panel_query(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_log(panel(spark, folder))


MODEL_COLUMNS = (
    "entity_id", "time_id", "nation", "year", "target", "target_log1p", "share_target",
    *[f"share_{n}" for n in CLASSES.values()], *[f"{v}_wmean" for v in WEIGHTED_VALUES], "balance_total",
    "absent_total", "not_there", "total_lines", "n_rows", "weight_sum", "snapshot_year", "snapshot_label",
)


def model(spark: SparkSession, folder: str) -> DataFrame:
    return modeling_panel(panel(spark, folder), MODEL_COLUMNS)


_MODEL_SQL = ", ".join("CAST(NULL AS DOUBLE) AS not_there" if c == "not_there" else c for c in MODEL_COLUMNS)


@query("modeling_panel", on_lines(f"SELECT {_MODEL_SQL} FROM p", PANEL_CTES))
def modeling_panel_query(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_log(model(spark, folder))


_SHARE_COLUMNS = {"share_target", *[f"share_{n}" for n in CLASSES.values()]}
_WMEANS = {f"{v}_wmean" for v in WEIGHTED_VALUES}
FEATURE_RULES = FeatureRules(
    rules=(
        FeatureRule(lambda c: c.startswith("target"), "target", "events", "Target.", "target", False, "annual"),
        FeatureRule(
            lambda c: c in _SHARE_COLUMNS, "derived_analysis", "events", "Share of a count.", "high", False, "annual"
        ),
        FeatureRule(
            lambda c: c in {"entity_id", "time_id", "nation", "year"}, "id", "panel", "Key.", "none", False, "metadata"
        ),
        FeatureRule(lambda c: c in _WMEANS, "feature", "survey", "Weighted mean of {name}.", "low", True, "annual"),
        FeatureRule(
            lambda c: c in ("balance_total", "absent_total"), "feature", "snapshot", "Snapshot of {name}.", "low",
            True, "static_1997",
        ),
        FeatureRule(lambda c: c == "total_lines", "control", "events", "Control.", "medium", False, "annual"),
        FeatureRule(lambda c: c in ("n_rows", "weight_sum"), "control", "survey", "Control.", "low", True, "annual"),
        FeatureRule(lambda c: c.startswith("snapshot_"), "metadata", "snapshot", "Control.", "low", True, "static_1997"),
    ),
    default=FeatureRule(lambda c: True, "metadata", "panel", "Auxiliary.", "review", False, "metadata"),
    base_name=lambda c: c.removesuffix("_wmean"),
)

CATALOG_DICTIONARY = [("price", "Price paid."), ("balance_total", "Balance of all suppliers."), ("nation", "unused")]

_CATALOG_SQL = """SELECT c AS feature_name,
  CASE WHEN c LIKE 'target%' OR c LIKE 'share_%' OR c = 'total_lines' THEN 'events'
   WHEN c IN ('entity_id', 'time_id', 'nation', 'year', 'not_there') THEN 'panel'
   WHEN c LIKE '%_wmean' OR c IN ('n_rows', 'weight_sum') THEN 'survey' ELSE 'snapshot' END AS source_dataset,
  CASE WHEN c LIKE 'target%' THEN 'target' WHEN c LIKE 'share_%' THEN 'derived_analysis'
   WHEN c IN ('entity_id', 'time_id', 'nation', 'year') THEN 'id'
   WHEN c LIKE '%_wmean' OR c IN ('balance_total', 'absent_total') THEN 'feature'
   WHEN c IN ('total_lines', 'n_rows', 'weight_sum') THEN 'control' ELSE 'metadata' END AS feature_role,
  CASE WHEN c IN ('nation', 'snapshot_label') THEN 'text'
   WHEN c IN ('entity_id', 'time_id', 'year', 'target', 'total_lines', 'n_rows', 'snapshot_year') THEN 'integer'
   ELSE 'numeric' END AS data_type,
  CASE WHEN c = 'price_wmean' THEN 'Price paid.' WHEN c = 'balance_total' THEN 'Balance of all suppliers.'
   WHEN c LIKE 'target%' THEN 'Target.' WHEN c LIKE 'share_%' THEN 'Share of a count.'
   WHEN c IN ('entity_id', 'time_id', 'nation', 'year') THEN 'Key.'
   WHEN c LIKE '%_wmean' THEN 'Weighted mean of ' || replace(c, '_wmean', '') || '.'
   WHEN c = 'absent_total' THEN 'Snapshot of absent_total.' WHEN c = 'not_there' THEN 'Auxiliary.'
   ELSE 'Control.' END AS description,
  CASE WHEN c LIKE 'target%' THEN 'target' WHEN c LIKE 'share_%' THEN 'high'
   WHEN c IN ('entity_id', 'time_id', 'nation', 'year') THEN 'none' WHEN c = 'total_lines' THEN 'medium'
   WHEN c = 'not_there' THEN 'review' ELSE 'low' END AS leakage_risk,
  c LIKE '%_wmean' OR c LIKE 'snapshot_%' OR c IN ('balance_total', 'absent_total', 'n_rows', 'weight_sum')
   AS recommended_for_modeling,
  CASE WHEN c IN ('entity_id', 'time_id', 'nation', 'year', 'not_there') THEN 'metadata'
   WHEN c LIKE 'snapshot_%' OR c IN ('balance_total', 'absent_total') THEN 'static_1997' ELSE 'annual' END AS temporal_behavior,
  '' AS notes, (SELECT count(*) FROM p) AS row_count,
  CASE WHEN c IN ('not_there', 'absent_total') THEN (SELECT count(*) FROM p)
   WHEN c = 'balance_total' THEN (SELECT count(*) FILTER (WHERE balance_total IS NULL) FROM p) ELSE 0 END AS null_count"""


@query(
    "feature_catalog",
    on_lines(
        f"{_CATALOG_SQL} FROM (SELECT unnest([{', '.join(repr(c) for c in MODEL_COLUMNS)}]) AS c)", PANEL_CTES
    ),
)
def feature_catalog_query(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue of the modelling panel with the measured coverage of every column."""
    frame = cut_lineage(model(spark, folder))
    dictionary = spark.createDataFrame(CATALOG_DICTIONARY, "variable string, description string")
    coverage = ag.null_report(frame).select(F.col("column_name").alias("feature_name"), "row_count", "null_count")
    return feature_catalog(frame, FEATURE_RULES, dictionary).join(coverage, "feature_name")


@query(
    "model_matrix",
    on_lines(
        """SELECT nation, year, target, price_wmean, discount_wmean, tax_wmean, balance_total, absent_total, n_rows,
        weight_sum, snapshot_year FROM p""",
        PANEL_CTES,
    ),
)
def model_matrix_query(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric recommended columns and the target, chosen by the catalogue."""
    frame = model(spark, folder)
    return model_matrix(frame, feature_catalog(frame, FEATURE_RULES), "target", ["nation", "year"])


# --- Dimensions ---------------------------------------------------------------------------------------------------


def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))

    def months(table: str, date: str) -> DataFrame:
        return load(spark, folder, table).select(time_id(F.year(date), F.month(date)).alias("time_id"))

    keys = [orders, months("orders", "o_orderdate"), months("lineitem", "l_shipdate"), months("events", "ts")]
    return star.dim_time(keys, "time_id", MONTHS, [SNAPSHOT_TIME])


_DIM_TIME = f"""k AS (SELECT CAST(year(o_orderdate) * 100 AS INTEGER) AS time_id FROM orders
  UNION SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) FROM orders
  UNION SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) FROM lineitem
  UNION SELECT CAST(year(ts) * 100 + month(ts) AS INTEGER) FROM events UNION SELECT {SNAPSHOT_TIME}),
 dim_time AS (SELECT time_id, time_id // 100 AS year, time_id % 100 AS month,
  CASE WHEN time_id % 100 = 0 THEN 'anual' ELSE {spanish_month_sql("time_id % 100")} END AS month_name,
  CAST(ceil((time_id % 100) / 3) AS INTEGER) AS quarter,
  CASE WHEN time_id % 100 <> 0 THEN 'mensual' WHEN time_id = {SNAPSHOT_TIME} THEN 'anual_snapshot' ELSE 'anual' END AS granularity
  FROM k)"""


@query("dim_time", f"WITH {_DIM_TIME} SELECT * FROM dim_time")
def dim_time_query(spark: SparkSession, folder: str) -> DataFrame:
    return dim_time(spark, folder)


@query(
    "dim_natural",
    """SELECT row_number() OVER (ORDER BY nation_id, p_brand, kind NULLS LAST) AS subarea_id, * FROM (
     SELECT DISTINCT s_nationkey AS nation_id, p_brand, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS kind
     FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE p_partkey % 5 <> 0)""",
)
def dim_natural(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (nation, brand, type) of what was sold; rows without a brand drop out, a missing type stays."""
    part = load(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("kind"),
    )
    supplier = load(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation_id"))
    sold = load(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    rows = sold.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    columns = ["nation_id", "p_brand", "kind"]
    return star.dim_natural(rows, columns, ["nation_id", "p_brand"], columns, "subarea_id")


def dim_entity(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(
        (F.col("n_nationkey") + 1).alias("entity_id"),
        F.col("n_name").alias("nation"),
        F.col("n_nationkey").alias("survey_code"),
        F.col("n_regionkey").alias("region_code"),
        F.col("r_name").alias("region_name"),
    )


@query(
    "dim_entity",
    """SELECT n_nationkey + 1 AS entity_id, n_name AS nation, n_nationkey AS survey_code, n_regionkey AS region_code,
      r_name AS region_name, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def dim_entity_query(spark: SparkSession, folder: str) -> DataFrame:
    """The entity dimension with the customers of each member."""
    used = load(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("survey_code")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    joined = dim_entity(spark, folder).join(used, "survey_code", "left")
    return joined.withColumn("customers", F.coalesce("customers", F.lit(0)))


def dim_subtype(spark: SparkSession) -> DataFrame:
    rows = [(i, name, f"Lines classed as {name}.", True) for i, name in enumerate(CLASSES, 1)]
    return star.dim_static(spark, rows, "subtype_id int, class string, description string, is_flagged boolean")


def dim_source(spark: SparkSession) -> DataFrame:
    rows = [(i, name, "derived" if name in ("flagged", "panel") else "parquet") for name, i in SOURCE_IDS.items()]
    return star.dim_static(spark, rows, "source_id int, source_name string, source_type string")


@query(
    "dim_static",
    on_lines(
        """SELECT 'subtype' AS dim, i AS id, c AS name, 'Lines classed as ' || c || '.' AS note, (SELECT count(*) FROM ev WHERE class = c) AS n_rows,
        (SELECT CAST(min(year) AS INTEGER) FROM ev WHERE class = c) AS first_year, (SELECT CAST(max(year) AS INTEGER) FROM ev WHERE class = c) AS last_year
        FROM (VALUES (1, 'PROMO_METAL'), (2, 'SMALL_RING'), (3, 'ROTARY'), (4, 'GEARING'), (5, 'FASTENER'), (6, 'DEVICE')) v(i, c)
        UNION ALL SELECT 'source', 3, 'events', 'parquet', count(*), CAST(min(year) AS INTEGER), CAST(max(year) AS INTEGER) FROM ev
        UNION ALL SELECT 'source', 4, 'flagged', 'derived', count(*), CAST(min(year) AS INTEGER), CAST(max(year) AS INTEGER) FROM ev WHERE class <> 'OTHER'"""
    ),
)
def dim_static(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed members of the class and source dimensions with the rows and years each covers."""
    cells = cut_lineage(sales(spark, folder, ["class", "year"], {"n": F.lit(1)}))
    measured = [F.sum("n").alias("n_rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year")]
    by_class = cells.groupBy("class").agg(*measured)
    every = cells.agg(*measured).withColumn("source_name", F.lit("events"))
    flagged = cells.where(F.col("class") != OTHER).agg(*measured).withColumn("source_name", F.lit("flagged"))
    subtypes = dim_subtype(spark).join(by_class, "class").select(
        F.lit("subtype").alias("dim"), F.col("subtype_id").alias("id"), F.col("class").alias("name"),
        F.col("description").alias("note"), "n_rows", "first_year", "last_year",
    )
    sources = dim_source(spark).join(every.unionByName(flagged), "source_name").select(
        F.lit("source").alias("dim"), F.col("source_id").alias("id"), F.col("source_name").alias("name"),
        F.col("source_type").alias("note"), "n_rows", "first_year", "last_year",
    )
    return subtypes.unionByName(sources)


# --- Facts --------------------------------------------------------------------------------------------------------


@query(
    "fact_annual",
    on_lines(
        """SELECT nation_id + 1 AS entity_id, year * 100 AS time_id, 3 AS source_id, count(*) AS total,
        CAST(sum(flag) AS BIGINT) AS flagged, CAST(count(*) - sum(flag) AS BIGINT) AS not_flagged,
        CAST(sum(flag) AS DOUBLE) / count(*) AS flagged_share FROM ev GROUP BY nation_id, year"""
    ),
)
def fact_annual(spark: SparkSession, folder: str) -> DataFrame:
    cells = sales(spark, folder, ["nation_id", "year"], {"n": F.lit(1), "f": flagged_line()})
    keyed = cells.withColumns({"entity_id": F.col("nation_id") + 1, "time_id": time_id("year")})
    counted = ag.counts_with_complement(
        keyed, ["entity_id", "time_id"], "total", "flagged", "not_flagged", "flagged_share", n="n", flag="f"
    )
    columns = ["entity_id", "time_id", "source_id", "total", "flagged", "not_flagged", "flagged_share"]
    return star.fact(counted, columns, {"source_id": SOURCE_IDS["events"]})


MONTH_FACT = "entity_id time_id subtype_id source_id n located mean_lat mean_lon".split()
_CLASS_ID = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLASSES, 1))
_MONTH_FACT_SQL = f"""SELECT nation_id + 1 AS entity_id, year * 100 + month AS time_id, CASE class {_CLASS_ID} END AS subtype_id,
 4 AS source_id, count(*) AS n, count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS located,
 CAST(sum(CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_discount AS DECIMAL(18,2)) END) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE l_orderkey % 7 <> 0), 0) AS mean_lat,
 CAST(sum(CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_tax AS DECIMAL(18,2)) END) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE l_orderkey % 7 <> 0), 0) AS mean_lon
 FROM ev WHERE class <> 'OTHER' GROUP BY nation_id, year, month, class"""


@query("fact_month_subtype", on_lines(_MONTH_FACT_SQL))
def fact_month_subtype(spark: SparkSession, folder: str) -> DataFrame:
    cells = located_sales(spark, folder, ["nation_id", "year", "month", "class"])
    cells = cells.where(F.col("class") != OTHER)
    keyed = cells.withColumns({"entity_id": F.col("nation_id") + 1, "time_id": time_id("year", F.col("month"))})
    members = star.fact_by_member(keyed, dim_subtype(spark).select("class", "subtype_id"), "class")
    return star.fact(members, MONTH_FACT, {"source_id": SOURCE_IDS["flagged"]})


@query(
    "fact_annual_wide",
    on_lines(
        f"""SELECT nation_id + 1 AS entity_id, year * 100 AS time_id, 4 AS source_id, count(*) AS total, {_PARTS},
        {rounded("ln(1 + count(*))")} AS total_log1p FROM ev WHERE class <> 'OTHER' GROUP BY nation_id, year"""
    ),
)
def fact_annual_wide(spark: SparkSession, folder: str) -> DataFrame:
    cells = sales(spark, folder, ["nation_id", "year", "class"], {"n": F.lit(1)}).where(F.col("class") != OTHER)
    keyed = cells.withColumns({"entity_id": F.col("nation_id") + 1, "time_id": time_id("year")})
    wide = ag.wide_counts(keyed, ["entity_id", "time_id"], "class", CLASSES, "total", "total_log1p", n="n")
    columns = ["entity_id", "time_id", "source_id", "total", *CLASSES.values(), "total_log1p"]
    return star.fact(wide, columns, {"source_id": SOURCE_IDS["flagged"]}).withColumn(
        "total_log1p", F.round("total_log1p", 6)
    )


@query(
    "fact_survey",
    on_lines(
        """SELECT n_nationkey + 1 AS entity_id, year * 100 AS time_id, 1 AS source_id, n_rows, weight_sum, price_wmean,
        discount_wmean, tax_wmean FROM w JOIN nation ON n_name = nation""",
        f", w AS ({WEIGHTED_SQL})",
    ),
)
def fact_survey(spark: SparkSession, folder: str) -> DataFrame:
    ids = dim_entity(spark, folder).select("nation", "entity_id")
    keyed = star.fact_by_member(weighted_mean(spark, folder), ids, "nation").withColumn("time_id", time_id("year"))
    columns = ["entity_id", "time_id", "source_id", "n_rows", "weight_sum", *[f"{v}_wmean" for v in WEIGHTED_VALUES]]
    return star.fact(keyed, columns, {"source_id": SOURCE_IDS["survey"]})


@query(
    "fact_snapshot",
    f"""WITH s AS ({SUPPLIER_SQL}) SELECT n_nationkey + 1 AS entity_id, {SNAPSHOT_TIME} AS time_id, 2 AS source_id,
     snapshot_year, snapshot_label, subarea_count, balance_sum, balance_avg, CAST(NULL AS DOUBLE) AS lamps_sum
    FROM s JOIN nation ON n_name = nation""",
)
def fact_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    contract = StructType.fromDDL(
        "entity_id int, time_id int, source_id int, snapshot_year int, snapshot_label string, subarea_count bigint,"
        " balance_sum double, balance_avg double, lamps_sum double"
    )
    ids = dim_entity(spark, folder).select("nation", "entity_id")
    keyed = star.fact_by_member(snapshot_rollup(spark, folder), ids, "nation")
    return star.fact_conformed(keyed, contract, {"time_id": SNAPSHOT_TIME, "source_id": SOURCE_IDS["snapshot"]})


@query(
    "fact_panel",
    on_lines(
        """SELECT entity_id, time_id, 5 AS source_id, target, target_log1p, share_target, total_lines, n_rows, weight_sum,
        price_wmean, discount_wmean, tax_wmean, balance_total, snapshot_year, year, nation FROM p""",
        PANEL_CTES,
    ),
)
def fact_panel(spark: SparkSession, folder: str) -> DataFrame:
    columns = (
        "entity_id time_id source_id target target_log1p share_target total_lines n_rows weight_sum price_wmean"
        " discount_wmean tax_wmean balance_total snapshot_year year nation"
    ).split()
    return rounded_log(star.fact(panel(spark, folder), columns, {"source_id": SOURCE_IDS["panel"]}))


@query(
    "fact_lookup",
    """WITH f AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS kind, p_size FROM part),
    d AS (SELECT row_number() OVER (ORDER BY p_brand, kind NULLS LAST, p_size) AS subarea_id, * FROM
     (SELECT DISTINCT p_brand, kind, p_size FROM f WHERE p_size <= 40))
    SELECT p_partkey, subarea_id, 199700 AS time_id FROM f LEFT JOIN d ON f.p_brand = d.p_brand
     AND f.kind IS NOT DISTINCT FROM d.kind AND f.p_size = d.p_size""",
)
def fact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with the surrogate key of (brand, type, size); a null type matches the null member."""
    rows = load(spark, folder, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("kind"), "p_size"
    )
    natural = ["p_brand", "kind", "p_size"]
    dim = star.dim_natural(rows.where("p_size <= 40"), natural, ["p_brand"], natural, "subarea_id")
    keyed = star.fact_by_natural_key(rows, dim, natural, "subarea_id")
    return star.fact(keyed, ["p_partkey", "subarea_id", "time_id"], {"time_id": SNAPSHOT_TIME})


@query(
    "star_join",
    f"""WITH ev AS ({LINES_SQL}), {_DIM_TIME}, f AS ({_MONTH_FACT_SQL})
    SELECT nation, region_name, year, month_name, quarter, class, source_name, n, located FROM f
    JOIN (SELECT n_nationkey + 1 AS entity_id, n_name AS nation, r_name AS region_name FROM nation JOIN region
     ON n_regionkey = r_regionkey) USING (entity_id) JOIN dim_time USING (time_id)
    JOIN (VALUES (1, 'PROMO_METAL'), (2, 'SMALL_RING'), (3, 'ROTARY'), (4, 'GEARING'), (5, 'FASTENER'), (6, 'DEVICE'))
     v(subtype_id, class) USING (subtype_id) JOIN (VALUES (4, 'flagged')) x(source_id, source_name) USING (source_id)""",
)
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = olap.star_join(
        fact_month_subtype(spark, folder),
        {
            "entity_id": dim_entity(spark, folder),
            "time_id": dim_time(spark, folder),
            "subtype_id": dim_subtype(spark),
        },
    )
    # The source of a fact is a constant, so its member is attached as a column and not joined.
    named = joined.withColumn("source_name", lookup({i: name for name, i in SOURCE_IDS.items()}, F.col("source_id")))
    return named.select(
        "nation", "region_name", "year", "month_name", "quarter", "class", "source_name", "n", "located"
    )
