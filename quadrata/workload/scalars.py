"""Text, entity, date and number functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions import text as tx
from quadrata.functions.dates import iso_date, parse_date, parse_month, time_id
from quadrata.functions.numeric import coerce_numeric, keep_where, row_mean, row_sum
from quadrata.operators.aggregates import located_from_parts, located_parts
from quadrata.plans.sources import add_entity_fields
from quadrata.plans.territory import MONTH_NUMBERS
from quadrata.session import load, load_spread, scratch_path
from quadrata.sources import commits
from quadrata.streaming.counts import run_incremental
from quadrata.workload.aggregates import line_stream, placed_lines
from quadrata.workload.base import (
    CLASSES,
    CLASS_SQL,
    LABELS,
    MONTHS,
    NATIONS,
    cents,
    hundredths,
    on_lines,
    part_classes,
    query,
    rounded,
    sales,
    spanish_month_sql,
)


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def strip_accents(spark: SparkSession, folder: str) -> DataFrame:
    return load_spread(spark, folder, "documents").select("doc_id", tx.strip_accents("text").alias("plain"))


@query(
    "text_key",
    """SELECT doc_id, nullif(trim(regexp_replace(upper(replace(strip_accents(text), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g')),
      '') AS text_key FROM documents""",
)
def text_key(spark: SparkSession, folder: str) -> DataFrame:
    keyed = tx.with_text_keys(load_spread(spark, folder, "documents"), {"text_key": "text"})
    return keyed.select("doc_id", "text_key")


@query(
    "title_label",
    """WITH k AS (SELECT p_partkey, upper(p_name || ' ' || p_size || p_type) AS k FROM part)
    SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(k, '([A-Z]+|[^A-Z]+)'),
      lambda x: upper(x[1]) || lower(x[2:])), '') AS label FROM k""",
)
def title_label(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat("p_name", F.lit(" - "), F.col("p_size").cast("string"), "p_type")
    return load(spark, folder, "part").select("p_partkey", tx.title_label(tx.text_key(raw)).alias("label"))


@query("trim_strings", "SELECT p_partkey, p_name AS name, p_brand AS brand FROM part")
def trim_strings(spark: SparkSession, folder: str) -> DataFrame:
    padded = load(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit(" \t "), F.col("p_name"), F.lit(" \r\n")).alias("name"),
        F.concat(F.lit("　"), F.col("p_brand")).alias("brand"),
    )
    return tx.trim_strings(padded)


@query(
    "canonical_entity",
    """SELECT c_custkey, 'NATION ' || c_nationkey AS entity_key FROM customer WHERE c_custkey % 5 <> 4""",
)
def canonical_entity(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and spellings of nations; unknown ones drop out of the catalogue."""
    pick, nation = F.col("c_custkey") % 5, F.col("c_nationkey").cast("string")
    noisy = (
        F.when(pick == 0, F.concat(F.lit(" 0"), nation))
        .when(pick == 1, F.concat(nation, F.lit(".00")))
        .when(pick == 2, F.concat(F.lit("Country nátion_"), nation))
        .when(pick == 3, F.concat(F.lit("NATION--"), nation, F.lit(" (State)")))
        .otherwise(F.concat(nation, F.lit(".5")))
    )
    keyed = NATIONS.with_canonical(load(spark, folder, "customer"), "entity_key", noisy)
    return tx.pin(keyed.select("c_custkey", "entity_key"), "entity_key").where(NATIONS.contains("entity_key"))


@query(
    "entity_fields",
    """SELECT c_custkey, 'NATION ' || c_nationkey AS entity_key, 'Nation ' || c_nationkey AS entity_name,
      c_nationkey + 1 AS entity_id FROM customer""",
)
def entity_fields(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return add_entity_fields(customer, "c_nationkey", NATIONS, LABELS).drop("c_nationkey")


@query(
    "canonical_fallback",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN 'NATION ' || ((c_nationkey + 1) % 25)
      WHEN c_custkey % 7 = 0 THEN NULL ELSE 'NATION ' || c_nationkey END AS entity_key FROM customer""",
)
def canonical_fallback(spark: SparkSession, folder: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    primary = F.when(key % 3 == 1, "nowhere").when(key % 3 == 2, ((nation + 1) % 25).cast("string"))
    secondary = F.when(key % 7 != 0, F.concat(F.lit("nation "), nation.cast("string")))
    return load(spark, folder, "customer").select(
        "c_custkey", NATIONS.first_canonical(primary, secondary).alias("entity_key")
    )


@query(
    "classify_rules",
    f"""SELECT p_partkey, {CLASS_SQL} AS class, CASE WHEN {CLASS_SQL} = 'OTHER' THEN 0 ELSE 1 END AS flag FROM part""",
)
def classify_rules(spark: SparkSession, folder: str) -> DataFrame:
    return part_classes(spark, folder).withColumn("flag", tx.flag_in("class", CLASSES))


@query("flagged_layer", f"SELECT p_partkey, {CLASS_SQL} AS class FROM part WHERE {CLASS_SQL} <> 'OTHER'")
def flagged_layer(spark: SparkSession, folder: str) -> DataFrame:
    return classify_rules(spark, folder).where("flag = 1").drop("flag")


@query(
    "date_parts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
      CASE WHEN o_orderkey % 5 <> 0 OR (o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0)
        THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
      CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS month
    FROM orders""",
)
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = F.when(key % 13 == 0, "31/31/1998").when(key % 17 == 0, "0222-01-01").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    stated = F.when(key % 5 != 0, F.year("o_orderdate"))
    day = parse_date(text)
    return load(spark, folder, "orders").select(
        "o_orderkey",
        iso_date(day).alias("day"),
        F.coalesce(stated, F.year(day)).alias("year"),
        F.month(day).alias("month"),
    )


@query(
    "parse_month",
    f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(month(o_orderdate) AS INTEGER)
      WHEN 1 THEN CAST(month(o_orderdate) AS INTEGER) WHEN 2 THEN 9 END AS month,
      {spanish_month_sql("month(o_orderdate)")} AS month_name FROM orders""",
)
def month_of_text(spark: SparkSession, folder: str) -> DataFrame:
    pick, month = F.col("o_orderkey") % 6, F.month("o_orderdate")
    name = tx.lookup(MONTHS, month)
    text = (
        F.when(pick == 0, F.concat(F.lit(" "), F.initcap(name)))
        .when(pick == 1, F.lpad(month.cast("string"), 2, "0"))
        .when(pick == 2, "setiembre")
        .when(pick == 3, "13")
        .when(pick == 4, F.concat(month.cast("string"), F.lit(".0")))
        .otherwise("marz")
    )
    return load(spark, folder, "orders").select(
        "o_orderkey", parse_month(text, MONTH_NUMBERS).alias("month"), name.alias("month_name")
    )


@query(
    "time_id",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(year(o_orderdate) * 100 +
      CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE month(o_orderdate) END AS INTEGER) END AS time_id FROM orders""",
)
def time_key(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    year = F.when(key % 11 == 0, "x").otherwise(F.concat(F.year("o_orderdate"), F.lit(".0")))
    month = F.when(key % 4 != 0, F.month("o_orderdate"))
    return load(spark, folder, "orders").select("o_orderkey", time_id(year, month).alias("time_id"))


@query(
    "coerce_numeric",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 NOT IN (1, 2, 3, 4) THEN o_totalprice END AS price,
      o_custkey::DOUBLE AS customer FROM orders""",
)
def numbers_of_text(spark: SparkSession, folder: str) -> DataFrame:
    pick = F.col("o_orderkey") % 10
    text = F.col("o_totalprice").cast("string")
    price = F.when(pick == 1, "n/a").when(pick == 2, "12d").when(pick == 3, "NaN").when(pick == 4, "").otherwise(text)
    raw = load(spark, folder, "orders").select(
        "o_orderkey", price.alias("price"), F.concat(F.lit(" "), "o_custkey").alias("customer")
    )
    return coerce_numeric(raw, ["price", "customer", "absent"])


@query(
    "composite_index",
    f"""SELECT p_partkey, {rounded("(p_size + p_retailprice + length(p_name)) / 3")} AS mean_index,
      CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size END + CAST(length(p_name) AS INTEGER) AS sum_index FROM part""",
)
def composite_index(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").select(
        "p_partkey",
        "p_size",
        "p_retailprice",
        F.char_length("p_name").alias("letters"),
        keep_where(F.col("p_partkey") % 6 != 0, "p_size").alias("size_or_null"),
    )
    return part.select(
        "p_partkey",
        F.round(row_mean(["p_size", "p_retailprice", "letters"]), 6).alias("mean_index"),
        row_sum(["size_or_null", "letters"]).alias("sum_index"),
    )


LOCATED_SQL = """count(*) AS n, count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS located,
  CAST(sum(CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_discount AS DECIMAL(18,2)) END) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE l_orderkey % 7 <> 0), 0) AS mean_lat,
  CAST(sum(CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_tax AS DECIMAL(18,2)) END) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE l_orderkey % 7 <> 0), 0) AS mean_lon"""


def located_sales(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """Counts and mean coordinates; every seventh order has no first coordinate."""
    lat = F.when(F.col("l_orderkey") % 7 != 0, cents("l_discount"))
    summed = hundredths(sales(spark, folder, keys, located_parts(lat, cents("l_tax"))), "lat__sum", "lon__sum")
    return summed.select(*keys, *located_from_parts("n", "located", "mean_lat", "mean_lon"))


@query("geo_centroid", on_lines(f"SELECT nation, year, month, {LOCATED_SQL} FROM ev GROUP BY ALL"))
def geo_centroid(spark: SparkSession, folder: str) -> DataFrame:
    return located_sales(spark, folder, ["nation", "year", "month"])


@query("month_subtype", on_lines(f"SELECT nation, year, month, class, {LOCATED_SQL} FROM ev WHERE class <> 'OTHER' GROUP BY ALL"))
def month_subtype(spark: SparkSession, folder: str) -> DataFrame:
    counted = located_sales(spark, folder, ["nation", "year", "month", "class"])
    return counted.where(F.col("class") != "OTHER")


@query("stream_month_subtype", on_lines(f"SELECT nation, year, month, class, {LOCATED_SQL} FROM ev WHERE class <> 'OTHER' GROUP BY ALL"))
def stream_month_subtype(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream of line-item files, folded batch by batch."""
    keys = ["nation", "year", "month", "class"]
    lat = F.when(F.col("l_orderkey") % 7 != 0, cents("l_discount"))
    classes = part_classes(spark, folder).where(F.col("class") != "OTHER")

    def partial(lines: DataFrame) -> DataFrame:
        rows = placed_lines(spark, folder, lines.join(classes, F.col("l_partkey") == F.col("p_partkey")))
        terms = located_parts(lat, cents("l_tax"))
        return rows.groupBy(*keys).agg(*[F.sum(term).alias(name) for name, term in terms.items()])

    def fold(partials: DataFrame) -> DataFrame:
        sums = [c for c in partials.columns if c not in keys]
        folded = hundredths(partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]), "lat__sum", "lon__sum")
        return folded.select(*keys, *located_from_parts("n", "located", "mean_lat", "mean_lon"))

    return run_incremental(line_stream(spark, folder), partial, fold)


@query(
    "append_rerun",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL""",
)
def append_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Orders appended in two runs, one of which is run again, and counted from the committed table."""
    table = scratch_path(spark, "orders-by-run")
    rows = load(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), cents("o_totalprice").alias("total"))
    odd = F.col("year") % 2 == 1
    for run, part in (("odd", odd), ("even", ~odd), ("odd", odd)):
        commits.commit(rows.where(part), table, run, "append")
    stored = commits.read_committed(spark, table, rows.schema)
    return hundredths(stored.groupBy("year").agg(F.count("*").alias("n"), F.sum("total").alias("total")), "total")
