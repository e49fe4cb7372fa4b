"""Sources, sinks, schemas and profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.functions.names import normalize_columns, rename_if_absent, snake_case_col
from quadrata.operators.schema import conform, infer_types
from quadrata.plans.panel import describe
from quadrata.session import load, scratch_path
from quadrata.sources.discovery import Signature, discover_sources, merge_metrics, profile
from quadrata.sources.layers import read_layer, write_layer
from quadrata.sources.warehouse import load_warehouse
from quadrata.workload.base import TABLES, query


@query(
    "csv_roundtrip",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 11 <> 0 THEN 'say "' || o_orderpriority || '", ok' END AS note, o_totalprice
    FROM orders""",
)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    text = F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", ok'))
    layer = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 11 != 0, text).alias("note"),
        "o_totalprice",
    )
    path = scratch_path(spark, "orders-csv")
    write_layer(layer, path, "csv")
    return read_layer(spark, path, layer.schema)


SIGNATURES = {
    "sales": Signature(("purchase",), ("view", "click")),
    "account": Signature(("signup", "view")),
    "faults": Signature(("error",)),
}


@query(
    "source_discovery",
    """WITH f AS (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS path, count(*) AS size,
      list(DISTINCT event_type) AS cols FROM events GROUP BY 1),
    c AS (SELECT *, CASE
      WHEN list_contains(cols, 'purchase') AND (list_contains(cols, 'view') OR list_contains(cols, 'click')) THEN 'sales'
      WHEN list_contains(cols, 'signup') AND list_contains(cols, 'view') THEN 'account'
      WHEN list_contains(cols, 'error') THEN 'faults' END AS source_class FROM f)
    SELECT source_class, size, path FROM c WHERE source_class IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY source_class ORDER BY size DESC, path) = 1""",
)
def source_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """User days as files: the event types of the day are the columns, the events its size."""
    events = load(spark, folder, "events")
    path = F.concat_ws("/", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd"))
    typed = events.groupBy(path.alias("path"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    files = typed.groupBy("path").agg(F.sum("n").alias("size"), F.collect_list("event_type").alias("columns"))
    return discover_sources(files, SIGNATURES)


@query(
    "warehouse_load",
    """SELECT r_name, count(*) AS n_suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name""",
)
def warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    """CSV exports loaded under their declared schema into catalogue tables, then queried there."""
    tables, contracts = {}, {}
    for name in ("region", "nation", "supplier"):
        source = load(spark, folder, name)
        contracts[name] = source.schema
        path = scratch_path(spark, name)
        write_layer(source, path, "csv")
        tables[name] = read_layer(spark, path, source.schema)
    db = f"quadrata_{uuid.uuid4().hex[:8]}"
    load_warehouse(spark, db, tables, contracts)
    return spark.sql(
        f"""SELECT r_name, count(*) AS n_suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {db}.supplier JOIN {db}.nation ON s_nationkey = n_nationkey
        JOIN {db}.region ON n_regionkey = r_regionkey GROUP BY r_name"""
    )


@query(
    "metrics_upsert",
    """SELECT 'rows.' || CAST(year(o_orderdate) AS VARCHAR) AS metric, count(*) AS value FROM orders
      WHERE year(o_orderdate) < 1998 GROUP BY 1
    UNION ALL SELECT 'rows.' || CAST(year(l_shipdate) AS VARCHAR), count(*) FROM lineitem
      WHERE year(l_shipdate) >= 1998 GROUP BY 1""",
)
def metrics_upsert(spark: SparkSession, folder: str) -> DataFrame:
    def rows_by_year(table: str, date: str) -> DataFrame:
        year = F.year(date)
        counted = load(spark, folder, table).groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("value"))
        return counted.select(F.concat(F.lit("rows."), F.col("year")).alias("metric"), "value", "year")

    first = rows_by_year("orders", "o_orderdate").drop("year")
    second = rows_by_year("lineitem", "l_shipdate").where("year >= 1998").drop("year")
    return merge_metrics(first, second)


DICTIONARY = [("view", "Page shown."), ("click", "Link followed."), ("purchase", "Order placed.")]


@query(
    "dict_enrich",
    """SELECT event_type AS variable, count(*) AS n, CASE event_type WHEN 'view' THEN 'Page shown.'
      WHEN 'click' THEN 'Link followed.' WHEN 'purchase' THEN 'Order placed.'
      ELSE 'Variable ' || event_type || '.' END AS description FROM events GROUP BY event_type""",
)
def dict_enrich(spark: SparkSession, folder: str) -> DataFrame:
    counted = load(spark, folder, "events").groupBy(F.col("event_type").alias("variable")).agg(F.count(F.lit(1)).alias("n"))
    dictionary = spark.createDataFrame(DICTIONARY, "variable string, description string")
    return describe(counted, "variable", dictionary, "Variable %s.")


@query(
    "snake_case",
    """WITH v AS (SELECT p_name AS value FROM part UNION SELECT p_brand FROM part UNION
      SELECT c_mktsegment FROM customer UNION SELECT o_orderpriority FROM orders UNION
      SELECT '%' || l_returnflag || '% Año' FROM lineitem),
    s AS (SELECT value, regexp_replace(regexp_replace(lower(strip_accents(value)), '[^a-z0-9]+', '_', 'g'),
      '^_+|_+$', '', 'g') AS s FROM v)
    SELECT value, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'c_' || s ELSE s END AS snake FROM s""",
)
def snake_case(spark: SparkSession, folder: str) -> DataFrame:
    def values(table: str, col) -> DataFrame:
        return load(spark, folder, table).select(F.col(col).alias("value") if isinstance(col, str) else col).distinct()

    marked = F.concat(F.lit("%"), F.col("l_returnflag"), F.lit("% Año")).alias("value")
    every = values("part", "p_name")
    for table, col in (("part", "p_brand"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority"), ("lineitem", marked)):
        every = every.unionByName(values(table, col))
    return every.distinct().select("value", snake_case_col("value").alias("snake"))


@query(
    "normalize_columns",
    """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS part_name_2, p_size AS anio,
      p_type AS c_2nd_type, p_retailprice AS columna FROM part""",
)
def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_type", "p_retailprice")
    messy = part.toDF("Part Key", "PART--Name", " part name ", "Año", "2nd Type", "%%")
    return rename_if_absent(normalize_columns(messy), "ano", "anio")


@query(
    "conform_schema",
    """SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS s_phone, CAST(s_nationkey AS BIGINT) AS s_nationkey,
      CAST(NULL AS DOUBLE) AS s_rating FROM supplier""",
)
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    contract = T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_phone", T.StringType()),
            T.StructField("s_nationkey", T.LongType()),
            T.StructField("s_rating", T.DoubleType()),
        ]
    )
    return conform(load(spark, folder, "supplier"), contract)


@query(
    "infer_types",
    """WITH p AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity % 1 = 0) AS q,
      count(*) FILTER (WHERE l_extendedprice % 1 = 0) AS e, count(*) FILTER (WHERE l_orderkey % 9 <> 0) AS k FROM lineitem)
    SELECT 'fecha_envio' AS column_name, 'date' AS inferred_type, n AS non_null FROM p
    UNION ALL SELECT 'order_id', 'integer', k FROM p
    UNION ALL SELECT 'edad', CASE WHEN q = n THEN 'bigint' ELSE 'double' END, n FROM p
    UNION ALL SELECT 'total_precio', CASE WHEN e = n THEN 'bigint' ELSE 'double' END, n FROM p
    UNION ALL SELECT 'share_descuento', 'double', n FROM p
    UNION ALL SELECT 'linea', 'bigint', n FROM p
    UNION ALL SELECT 'marca', 'text', n FROM p
    UNION ALL SELECT 'vacia', 'text', 0 FROM p
    UNION ALL SELECT 'es_final', 'boolean', n FROM p""",
)
def types_of_text(spark: SparkSession, folder: str) -> DataFrame:
    text = load(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("fecha_envio"),
        F.when(F.col("l_orderkey") % 9 != 0, F.col("l_orderkey")).cast("string").alias("order_id"),
        F.col("l_quantity").cast("string").alias("edad"),
        F.col("l_extendedprice").cast("string").alias("total_precio"),
        F.col("l_discount").cast("string").alias("share_descuento"),
        F.col("l_linenumber").cast("string").alias("linea"),
        F.col("l_returnflag").alias("marca"),
        F.lit(None).cast("string").alias("vacia"),
        (F.col("l_linestatus") == "F").cast("string").alias("es_final"),
    )
    return infer_types(text)


PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count,"
    f" CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS column_count,"
    f" (SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS original_names,"
    f" (SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS normalized_names FROM {t}"
    for t in TABLES
)


@query("profile", PROFILE_SQL)
def profile_tables(spark: SparkSession, folder: str) -> DataFrame:
    rows = [profile(load(spark, folder, t), t) for t in TABLES]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
