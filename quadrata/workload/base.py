"""Registry of queries, and the views of the driver tables that several queries share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions.entities import EntityCatalog
from quadrata.functions.dates import in_years, iso_date
from quadrata.functions.text import Rule, classify_rules, lookup, pin, with_text_keys
from quadrata.operators.along import Hop, sum_along
from quadrata.plans.sources import EventSpec, Labels
from quadrata.plans.territory import MONTH_NUMBERS, MONTHS
from quadrata.session import load, load_spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        REGISTRY[name] = Query(run, oracle)
        return run

    return register


# --- Classes of parts: ordered keyword rules over type and name --------------------------------------------------

CLASSES = {
    "PROMO_METAL": "promo_metal",
    "SMALL_RING": "small_ring",
    "ROTARY": "rotary",
    "GEARING": "gearing",
    "FASTENER": "fastener",
    "DEVICE": "device",
}
OTHER = "OTHER"
RULES = (
    Rule(OTHER, none_of=("RING", "ROD", "GEAR", "BOLT", "PLATE", "WIDGET")),
    Rule("PROMO_METAL", all_of=("PROMO",), any_of=("GEAR", "BOLT")),
    Rule("SMALL_RING", all_of=("RING",), any_of=("SMALL", "ECONOMY")),
    Rule("ROTARY", any_of=("RING", "ROD")),
    Rule("GEARING", any_of=("GEAR",)),
    Rule("FASTENER", any_of=("BOLT", "PLATE")),
    Rule("DEVICE", any_of=("WIDGET",)),
)


def part_text() -> Column:
    return F.concat_ws(" ", "p_type", "p_name")


def with_class(part: DataFrame, name: str = "class") -> DataFrame:
    """Add the class. The key is a column of its own, so that it is computed once and not once per rule."""
    keyed = with_text_keys(part, {"_key": part_text()})
    return pin(keyed.withColumn(name, classify_rules("_key", RULES, OTHER)).drop("_key"), name)


def part_classes(spark: SparkSession, folder: str) -> DataFrame:
    """(p_partkey, class)"""
    return with_class(load(spark, folder, "part")).select("p_partkey", "class")


_TXT = "upper(p_type || ' ' || p_name)"
CLASS_SQL = f"""CASE
 WHEN NOT regexp_matches({_TXT}, 'RING|ROD|GEAR|BOLT|PLATE|WIDGET') THEN 'OTHER'
 WHEN regexp_matches({_TXT}, 'PROMO') AND regexp_matches({_TXT}, 'GEAR|BOLT') THEN 'PROMO_METAL'
 WHEN regexp_matches({_TXT}, 'RING') AND regexp_matches({_TXT}, 'SMALL|ECONOMY') THEN 'SMALL_RING'
 WHEN regexp_matches({_TXT}, 'RING|ROD') THEN 'ROTARY'
 WHEN regexp_matches({_TXT}, 'GEAR') THEN 'GEARING'
 WHEN regexp_matches({_TXT}, 'BOLT|PLATE') THEN 'FASTENER'
 WHEN regexp_matches({_TXT}, 'WIDGET') THEN 'DEVICE'
 ELSE 'OTHER' END"""

# --- Nations as the entity catalogue ----------------------------------------------------------------------------

NATION_KEYS = tuple(f"NATION {i}" for i in range(25))
NATIONS = EntityCatalog(
    keys=NATION_KEYS,
    codes=dict(enumerate(NATION_KEYS)),
    aliases={key: key for key in NATION_KEYS},
    affixes=("COUNTRY", "STATE"),
)
YEARS = tuple(range(1995, 2002))
SOURCE_IDS = {"survey": 1, "snapshot": 2, "events": 3, "flagged": 4, "panel": 5}
SNAPSHOT_TIME = 199700


def money(col: str) -> Column:
    """Exact amount of a small table."""
    return F.col(col).cast("decimal(18,2)")


def cents(col: str) -> Column:
    """Exact hundredths as whole numbers: sums do not depend on the order of the rows and stay in fast code."""
    return F.rint(F.col(col) * 100).cast("bigint")


def hundredths(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of :func:`cents` back as amounts."""
    return df.withColumns({c: F.col(c) / 100 for c in columns})


# --- Line items by nation, period and class ---------------------------------------------------------------------


def sales(
    spark: SparkSession,
    folder: str,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    lines: Callable[[DataFrame], DataFrame] = lambda df: df,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Sums of line-item terms per any of: class, year, month, priority, nation_id, nation, segment.

    Only the tables that carry a requested key are joined. ``years`` keeps the orders of a range of years.
    """
    wanted = set(keys)
    fact = lines(load(spark, folder, "lineitem"))
    hops = []
    if "class" in wanted:
        hops.append(Hop(part_classes(spark, folder), "l_partkey", "p_partkey"))
    if wanted - {"class"}:
        dated = load(spark, folder, "orders")
        orders = (dated if years is None else dated.where(in_years("o_orderdate", *years))).select(
            "o_orderkey",
            "o_custkey",
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.col("o_orderpriority").alias("priority"),
        )
        hops.append(Hop(orders, "l_orderkey", "o_orderkey"))
    if wanted & {"nation", "nation_id", "segment"}:
        customer = load(spark, folder, "customer").select(
            "c_custkey", F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment")
        )
        hops.append(Hop(customer, "o_custkey", "c_custkey"))
    if "nation" in wanted:
        nation = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
        hops.append(Hop(nation, "nation_id", "n_nationkey"))
    return sum_along(fact, hops, keys, sums)



def flagged_line() -> Column:
    return F.when(F.col("l_returnflag") == "R", 1).otherwise(0)


LINES_SQL = f"""
 SELECT n.n_name AS nation, n.n_nationkey AS nation_id, CAST(year(o.o_orderdate) AS INTEGER) AS year,
  CAST(month(o.o_orderdate) AS INTEGER) AS month, o.o_orderpriority AS priority, c.c_mktsegment AS segment,
  {CLASS_SQL} AS class, CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS flag, l.*
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey"""


def on_lines(select: str, ctes: str = "") -> str:
    """SQL over the joined line items, named ``ev``."""
    return f"WITH ev AS ({LINES_SQL}){ctes} {select}"


# --- Raw event records with defects: unreadable dates, missing fields, unknown places ----------------------------

LABELS = Labels()
EVENTS = EventSpec(
    catalog=NATIONS,
    rules=RULES,
    default_class=OTHER,
    class_columns=CLASSES,
    month_names=MONTH_NUMBERS,
    years=(1996, 2000),
    lat_range=(0.02, 0.08),
    lon_range=(0.01, 0.07),
    date="event_date",
    start_date="start_date",
    year="event_year",
    month="event_month",
    entity="place",
    fallback_entity="listed_place",
    text="what",
    category="category",
    subarea="area",
    fallback_subarea="listed_area",
    lat="lat",
    lon="lon",
    clean_year="clean_year",
    clean_month="clean_month",
    text_key="what_key",
    subarea_key="area_key",
    event_class="event_class",
    flag="is_flagged",
    labels=LABELS,
)


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of an order are spelled out before the join with its lines, so the lines are dealt by part and by order only."""
    order, line = F.col("o_orderkey"), F.col("l_linenumber")
    nation = F.col("c_nationkey").cast("string")
    orders, customer = load(spark, folder, "orders"), load(spark, folder, "customer")
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        order,
        F.when(order % 13 == 0, " not a date ").otherwise(iso_date("o_orderdate")).alias("Event Date"),
        F.when(order % 5 != 0, F.year("o_orderdate").cast("string")).alias("event_year"),
        F.when(order % 26 == 0, "marz").otherwise(F.initcap(lookup(MONTHS, F.month("o_orderdate")))).alias("event_month"),
        F.when(order % 3 == 1, F.concat(F.lit("Country Nátion_"), nation))
        .when(order % 3 == 2, F.concat(F.lit(" "), nation))
        .alias("place"),
        F.when(order % 7 == 0, "Atlantis").otherwise(F.concat(nation, F.lit(".0"))).alias("listed_place"),
        "c_mktsegment",
        F.col("o_orderpriority").alias("listed_area"),
    )
    parts = load(spark, folder, "part").select("p_partkey", part_text().alias("what"))
    rows = (
        load_spread(spark, folder, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(ordered, F.col("l_orderkey") == order)
    )
    return rows.select(
        "Event Date",
        iso_date("l_shipdate").alias("start_date"),
        "event_year",
        "event_month",
        "place",
        "listed_place",
        "what",
        F.col("l_returnflag").alias("category"),
        F.when(line != 1, F.col("c_mktsegment")).alias("area"),
        "listed_area",
        F.when(line != 2, F.col("l_discount").cast("string")).otherwise("?").alias("lat"),
        F.col("l_tax").cast("string").alias("lon"),
    )


_MONTH_SQL = "[" + ", ".join(f"'{m}'" for m in MONTHS.values()) + "]"
EVENTS_SQL = f"""derived AS (
 SELECT CASE WHEN l_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS event_date,
  strftime(l_shipdate, '%Y-%m-%d') AS start_date,
  CASE WHEN l_orderkey % 5 <> 0 OR l_orderkey % 13 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS clean_year,
  CASE WHEN l_orderkey % 26 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS clean_month,
  p_type || ' ' || p_name AS what, upper(p_type || ' ' || p_name) AS what_key, l_returnflag AS category,
  CASE WHEN l_orderkey % 3 <> 0 OR l_orderkey % 7 <> 0 THEN 'NATION ' || c_nationkey END AS entity_key,
  CASE WHEN l_orderkey % 3 <> 0 OR l_orderkey % 7 <> 0 THEN 'Nation ' || c_nationkey END AS entity_name,
  CASE WHEN l_orderkey % 3 <> 0 OR l_orderkey % 7 <> 0 THEN c_nationkey + 1 END AS entity_id,
  CASE WHEN l_linenumber <> 1 THEN c_mktsegment ELSE o_orderpriority END AS area,
  CASE WHEN l_linenumber <> 2 THEN l_discount END AS lat, l_tax AS lon, {CLASS_SQL} AS event_class,
  CASE WHEN {CLASS_SQL} = 'OTHER' THEN 0 ELSE 1 END AS is_flagged
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey),
clean AS (
 SELECT *, trim(regexp_replace(upper(area), '[^A-Z0-9]+', ' ', 'g')) AS area_key FROM derived
 WHERE entity_key IS NOT NULL AND clean_year BETWEEN 1996 AND 2000 AND clean_month BETWEEN 1 AND 12)"""


def on_events(select: str) -> str:
    """SQL over the derived events (``derived``) and the valid ones (``clean``)."""
    return f"WITH {EVENTS_SQL} {select}"


def rounded(sql: str, digits: int = 6) -> str:
    """SQL rounding half away from zero on the decimal expansion, without negative zero."""
    return f"(CAST(round(CAST({sql} AS DECIMAL(30,12)), {digits}) AS DOUBLE) + 0.0)"


def spanish_month_sql(expression: str) -> str:
    return f"{_MONTH_SQL}[{expression}]"
