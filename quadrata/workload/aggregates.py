"""Grouped counts, weighted means, pivots, OLAP and rankings over the line items."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions.numeric import share
from quadrata.operators import aggregates as ag
from quadrata.operators import olap, ordered, sets
from quadrata.plans.sources import clean_events, derive_events, reject_counters
from quadrata.session import load
from quadrata.streaming.counts import file_stream, run_incremental
from quadrata.sources.layers import is_folder
from quadrata.workload.base import (
    CLASSES,
    EVENTS,
    YEARS,
    cents,
    flagged_line,
    hundredths,
    money,
    on_events,
    on_lines,
    query,
    raw_events,
    rounded,
    sales,
)


def counts(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    return sales(spark, folder, keys, {"n": F.lit(1), "flagged": flagged_line()})


def revenue(spark: SparkSession, folder: str, keys: list[str], years: tuple[int, int] | None = None) -> DataFrame:
    return sales(spark, folder, keys, {"n": F.lit(1), "revenue": cents("l_extendedprice")}, years=years)


REVENUE_SQL = "count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue"

ANNUAL_SQL = """SELECT nation, year, count(*) AS total, CAST(sum(flag) AS BIGINT) AS flagged,
 CAST(count(*) - sum(flag) AS BIGINT) AS not_flagged, CAST(sum(flag) AS DOUBLE) / count(*) AS flagged_share
 FROM ev GROUP BY nation, year"""


@query("annual_counts", on_lines(ANNUAL_SQL))
def annual_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, flagged ones, complement and share per nation and year."""
    folded = counts(spark, folder, ["nation", "year"])
    return ag.counts_with_complement(
        folded, ["nation", "year"], "total", "flagged", "not_flagged", "flagged_share", n="n", flag="flagged"
    )


@query("stream_counts", on_lines(ANNUAL_SQL))
def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts from a stream of line-item files joined with the static tables, folded batch by batch."""
    keys = ["nation", "year"]

    def partial(lines: DataFrame) -> DataFrame:
        rows = placed_lines(spark, folder, lines).withColumn("flag", flagged_line())
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("flag").cast("bigint").alias("flagged"))

    def fold(partials: DataFrame) -> DataFrame:
        return ag.counts_with_complement(partials, keys, "total", "flagged", "not_flagged", "flagged_share", n="n", flag="flagged")

    return run_incremental(line_stream(spark, folder), partial, fold)


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The line items as a stream of files."""
    path = f"{folder.rstrip('/')}/lineitem.parquet"
    schema = load(spark, folder, "lineitem").schema
    if is_folder(spark, path):
        return file_stream(spark, path, "*.parquet", schema)
    return file_stream(spark, folder, "lineitem.parquet", schema)


def placed_lines(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Line items with nation, year and month of their order."""
    date = F.col("o_orderdate")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year(date).alias("year"), F.month(date).alias("month"))
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    ordered = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return ordered.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


WEIGHTED_VALUES = {"price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}


def _weighted_sql(name: str, column: str) -> str:
    value = f"CAST(round({column} * 100) AS BIGINT)"
    weight = "CASE WHEN l_orderkey % 7 <> 0 AND l_linenumber <> 3 THEN CAST(round(l_quantity * 100) AS BIGINT) END"
    return f"CAST(sum({value} * {weight}) AS DOUBLE) / nullif(CAST(sum({weight}) AS DOUBLE), 0) / 100 AS {name}_wmean"


WEIGHTED_SQL = f"""SELECT nation, year, count(*) AS n_rows, coalesce(sum(CASE WHEN l_orderkey % 7 <> 0
 THEN l_quantity END), 0) AS weight_sum,
 {", ".join(_weighted_sql(n, c) for n, c in WEIGHTED_VALUES.items())} FROM ev GROUP BY nation, year"""


def weighted_terms() -> dict:
    """Rows, weights and weighted values of the line items in hundredths; values and weights have gaps.

    Products of price and quantity outgrow a 64-bit sum over everything, so those two are decimals.
    """
    weight = F.when(F.col("l_orderkey") % 7 != 0, cents("l_quantity"))
    values = {n: F.when(F.col("l_linenumber") != 3, cents(c)) for n, c in WEIGHTED_VALUES.items()}
    price = {"price": values.pop("price").cast("decimal(9,0)")}
    return {
        "n_rows": F.lit(1),
        "weight_sum": weight,
        **ag.weighted_parts(price, weight.cast("decimal(8,0)")),
        **ag.weighted_parts(values, weight),
    }


def weighted_columns() -> list:
    means = ag.weighted_from_parts(list(WEIGHTED_VALUES), "")
    named = [(mean / 100).alias(f"{name}_wmean") for name, mean in zip(WEIGHTED_VALUES, means, strict=True)]
    return ["n_rows", F.coalesce(F.col("weight_sum") / 100, F.lit(0.0)).alias("weight_sum"), *named]


@query("weighted_mean", on_lines(WEIGHTED_SQL))
def weighted_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Means weighted by quantity per nation and year."""
    summed = sales(spark, folder, ["nation", "year"], weighted_terms())
    return summed.select("nation", "year", *weighted_columns())


SUPPLIER_SQL = """SELECT n_name AS nation, count(DISTINCT s_name) AS subarea_count,
 CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance_sum,
 CAST(sum(s_suppkey % 10) AS DOUBLE) AS grade_sum,
 CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS balance_avg,
 CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance_total, CAST(NULL AS DOUBLE) AS absent_total,
 1997 AS snapshot_year, 'static_1997' AS snapshot_label
 FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"""


@query("snapshot_rollup", SUPPLIER_SQL)
def snapshot_rollup(spark: SparkSession, folder: str) -> DataFrame:
    nation = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    supplier = load(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = supplier.select("nation", "s_name", money("s_acctbal").alias("balance"), (F.col("s_suppkey") % 10).alias("grade"))
    return ag.snapshot_rollup(
        rows,
        ["nation"],
        "s_name",
        {"balance_sum": "balance", "grade_sum": "grade", "gone_sum": "gone"},
        {"balance_avg": "balance"},
        {"balance_total": "balance_sum", "absent_total": "gone_sum"},
        "subarea_count",
        {"snapshot_year": 1997, "snapshot_label": "static_1997"},
    )


_WIDE = ", ".join(f"count(*) FILTER (WHERE class = '{v}') AS {n}" for v, n in CLASSES.items())
WIDE_SQL = f"""SELECT nation, year, count(*) AS total, {_WIDE}, {rounded("ln(1 + count(*))")} AS total_log1p
 FROM ev WHERE class <> 'OTHER' GROUP BY nation, year"""


@query("annual_pivot", on_lines(WIDE_SQL))
def annual_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return annual_wide(spark, folder).withColumn("total_log1p", F.round("total_log1p", 6))


def annual_wide(spark: SparkSession, folder: str) -> DataFrame:
    folded = sales(spark, folder, ["nation", "year", "class"], {"n": F.lit(1)}).where("class <> 'OTHER'")
    return ag.wide_counts(folded, ["nation", "year"], "class", CLASSES, "total", "total_log1p", n="n")


_SHARES = ", ".join(f"CAST({n} AS DOUBLE) / nullif(total, 0) AS share_{n}" for n in CLASSES.values())


@query("shares", on_lines(f"SELECT nation, year, {_SHARES} FROM w", f", w AS ({WIDE_SQL})"))
def shares(spark: SparkSession, folder: str) -> DataFrame:
    wide = annual_wide(spark, folder)
    return wide.select("nation", "year", *[share(n, "total").alias(f"share_{n}") for n in CLASSES.values()])


_MATRIX = ", ".join(f"count(*) FILTER (WHERE year = {y}) AS y{y}" for y in YEARS)


@query("heatmap", on_lines(f"SELECT nation, {_MATRIX} FROM ev GROUP BY nation"))
def heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return ag.matrix(counts(spark, folder, ["nation", "year"]), "nation", "year", YEARS, "n", "y")


@query(
    "value_ranges",
    """WITH v AS (SELECT 'order_year' AS column_name, year(o_orderdate) AS value FROM orders
     UNION ALL SELECT 'order_month', month(o_orderdate) FROM orders)
    SELECT column_name, CAST(value AS BIGINT) AS value, count(*) AS n,
     CAST(min(min(value)) OVER (PARTITION BY column_name) AS BIGINT) AS min_value,
     CAST(max(max(value)) OVER (PARTITION BY column_name) AS BIGINT) AS max_value FROM v GROUP BY column_name, value""",
)
def value_ranges(spark: SparkSession, folder: str) -> DataFrame:
    dates = load(spark, folder, "orders").select(
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month")
    )
    return ag.value_ranges(dates, dates.columns)


_NULLED = {"l_orderkey": 0, "l_quantity": 7, "l_discount": 11, "l_returnflag": 13}


@query(
    "null_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {f"l_orderkey % {m} = 0" if m else "false"}) AS null_count,
        count(*) AS row_count, CAST(count(*) FILTER (WHERE {f"l_orderkey % {m} = 0" if m else "false"}) AS DOUBLE) / count(*)
        AS null_pct FROM lineitem"""
        for c, m in _NULLED.items()
    ),
)
def null_report(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        *[F.when(F.col("l_orderkey") % m != 0, F.col(c)).alias(c) if m else F.col(c) for c, m in _NULLED.items()]
    )
    return ag.null_report(lines)


# --- Events with defects ------------------------------------------------------------------------------------------


@query(
    "event_clean",
    on_events(
        """SELECT event_date, start_date, clean_year, clean_month, what, what_key, category, entity_key, entity_name,
        area_key, area, lat, lon, event_class, is_flagged FROM clean"""
    ),
)
def event_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_events(raw_events(spark, folder), EVENTS)


_VALID = "entity_key IS NOT NULL AND coalesce(clean_year BETWEEN 1996 AND 2000, false) AND coalesce(clean_month BETWEEN 1 AND 12, false)"
_READABLE = "clean_year IS NOT NULL AND coalesce(clean_month BETWEEN 1 AND 12, false)"
_BOX = "lat BETWEEN 0.02 AND 0.08 AND lon BETWEEN 0.01 AND 0.07"


@query(
    "reject_counters",
    on_events(
        f"""SELECT count(*) AS original_rows, count(*) FILTER (WHERE {_VALID}) AS clean_rows,
        count(*) FILTER (WHERE {_VALID} AND is_flagged = 1) AS flagged_rows,
        count(*) FILTER (WHERE entity_key IS NULL) AS invalid_entity,
        count(*) FILTER (WHERE NOT ({_READABLE})) AS unreadable_period,
        count(*) FILTER (WHERE {_READABLE} AND NOT clean_year BETWEEN 1996 AND 2000) AS outside_years,
        count(*) FILTER (WHERE {_VALID} AND lat IS NOT NULL) AS with_coordinates,
        count(*) FILTER (WHERE {_VALID} AND lat IS NULL) AS without_coordinates,
        count(*) FILTER (WHERE {_VALID} AND lat IS NOT NULL AND NOT ({_BOX})) AS outside_box FROM derived"""
    ),
)
def event_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return reject_counters(derive_events(raw_events(spark, folder), EVENTS), EVENTS)


# --- Periods and sets ---------------------------------------------------------------------------------------------


@query(
    "common_periods",
    """WITH s AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
     INTERSECT SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) FROM lineitem)
    SELECT year FROM s WHERE year IN (1996, 1998, 2000) OR (SELECT count(*) FROM s WHERE year IN (1996, 1998, 2000)) < 3""",
)
def common_periods(spark: SparkSession, folder: str) -> DataFrame:
    ordered_in = load(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    shipped_in = load(spark, folder, "lineitem").select(F.year("l_shipdate").alias("year"))
    return sets.common_periods([ordered_in, shipped_in], "year", (1996, 1998, 2000))


@query(
    "set_difference",
    """SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997""",
)
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without an order in a year."""
    active = load(spark, folder, "orders").where(F.col("o_orderdate").between(F.lit(date(1997, 1, 1)), F.lit(date(1997, 12, 31))))
    return sets.missing_keys(load(spark, folder, "customer"), active, "c_custkey", "o_custkey")


@query(
    "fk_orphans",
    """SELECT l_returnflag, count(*) AS orphans FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45)
     ON l_partkey = p_partkey WHERE p_partkey IS NULL GROUP BY l_returnflag""",
)
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    known = load(spark, folder, "part").where("p_size <= 45")
    lost = sets.orphans(load(spark, folder, "lineitem"), known, "l_partkey", "p_partkey")
    return lost.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))


# --- OLAP ---------------------------------------------------------------------------------------------------------


@query("olap_slice", on_lines(f"SELECT nation, year, class, {REVENUE_SQL} FROM ev WHERE year = 1997 GROUP BY nation, year, class"))
def olap_slice(spark: SparkSession, folder: str) -> DataFrame:
    return olap.cut(hundredths(revenue(spark, folder, ["nation", "year", "class"], (1997, 1997)), "revenue"), {"year": 1997})


@query(
    "olap_dice",
    on_lines(
        f"""SELECT nation, year, segment, priority, {REVENUE_SQL} FROM ev WHERE year BETWEEN 1996 AND 1998
        AND segment = 'BUILDING' AND priority IN ('1-URGENT', '2-HIGH') GROUP BY nation, year, segment, priority"""
    ),
)
def olap_dice(spark: SparkSession, folder: str) -> DataFrame:
    fact = hundredths(revenue(spark, folder, ["nation", "year", "segment", "priority"], (1996, 1998)), "revenue")
    return olap.cut(fact, {"year": (1996, 1998), "segment": "BUILDING", "priority": ["1-URGENT", "2-HIGH"]})


@query(
    "olap_rollup",
    on_lines(
        f"""SELECT nation, year, month, CAST(grouping(nation, year, month) AS INTEGER) AS level_id, {REVENUE_SQL}
        FROM ev GROUP BY ROLLUP (nation, year, month)"""
    ),
)
def olap_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The cells of the finest level are summed first; the subtotals expand only those."""
    cells = revenue(spark, folder, ["nation", "year", "month"])
    return olap.rollup(
        cells, ["nation", "year", "month"], {"n": F.sum("n"), "revenue": F.sum("revenue") / 100}
    )


@query(
    "olap_cube",
    on_lines(
        f"""SELECT year, class, CAST(grouping(year, class) AS INTEGER) AS level_id, {REVENUE_SQL}
        FROM ev GROUP BY CUBE (year, class)"""
    ),
)
def olap_cube(spark: SparkSession, folder: str) -> DataFrame:
    cells = revenue(spark, folder, ["year", "class"])
    return olap.cube(cells, ["year", "class"], {"n": F.sum("n"), "revenue": F.sum("revenue") / 100})


@query(
    "olap_drilldown",
    on_lines(f"SELECT year, month, class, {REVENUE_SQL} FROM ev WHERE nation = 'NATION_3' GROUP BY year, month, class"),
)
def olap_drilldown(spark: SparkSession, folder: str) -> DataFrame:
    cells = olap.cut(revenue(spark, folder, ["nation", "year", "month", "class"]), {"nation": "NATION_3"})
    return olap.drill_down(
        cells, ["year", "month", "class"], {"n": F.sum("n"), "revenue": F.sum("revenue") / 100}
    )


@query("totals", on_lines(f"SELECT class, {REVENUE_SQL} FROM ev GROUP BY class UNION ALL SELECT 'ALL', {REVENUE_SQL} FROM ev"))
def totals(spark: SparkSession, folder: str) -> DataFrame:
    cells = olap.rollup(
        revenue(spark, folder, ["class"]), ["class"], {"n": F.sum("n"), "revenue": F.sum("revenue") / 100}
    )
    return cells.select(F.when(F.col("level_id") == 1, "ALL").otherwise(F.col("class")).alias("class"), "n", "revenue")


@query("evolution", on_lines("SELECT nation, year, month, count(*) AS n FROM ev GROUP BY nation, year, month"))
def evolution(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder, ["nation", "year", "month"], {"n": F.lit(1)}).orderBy("nation", "year", "month")


# --- Rankings -----------------------------------------------------------------------------------------------------


@query(
    "ranking",
    on_lines(
        "SELECT *, rank() OVER (ORDER BY revenue DESC) AS place FROM r",
        f", r AS (SELECT nation, {REVENUE_SQL} FROM ev GROUP BY nation)",
    ),
)
def ranking(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.global_rank(hundredths(revenue(spark, folder, ["nation"]), "revenue"), "revenue", "place")


@query(
    "topk",
    on_lines(f"SELECT nation, {REVENUE_SQL} FROM ev WHERE year = 1997 GROUP BY nation ORDER BY revenue DESC, nation LIMIT 10"),
)
def topk(spark: SparkSession, folder: str) -> DataFrame:
    year = olap.cut(hundredths(revenue(spark, folder, ["nation", "year"]), "revenue"), {"year": 1997}).drop("year")
    return ordered.top_k(year, [F.col("revenue").desc(), F.col("nation")], 10)


@query(
    "predominant",
    on_lines(
        """SELECT nation, class, count(*) AS n FROM ev WHERE class <> 'OTHER' GROUP BY nation, class
        QUALIFY row_number() OVER (PARTITION BY nation ORDER BY count(*) DESC, class) = 1"""
    ),
)
def predominant(spark: SparkSession, folder: str) -> DataFrame:
    cells = sales(spark, folder, ["nation", "class"], {"n": F.lit(1)}).where("class <> 'OTHER'")
    return ordered.predominant(cells, "nation", "class", "n")


@query(
    "yoy_change",
    on_lines(
        """SELECT nation, year, n, lag(n) OVER w AS previous, n - lag(n) OVER w AS change,
        CAST(n - lag(n) OVER w AS DOUBLE) / lag(n) OVER w AS change_rate FROM c WINDOW w AS (PARTITION BY nation ORDER BY year)""",
        ", c AS (SELECT nation, year, count(*) AS n FROM ev GROUP BY nation, year)",
    ),
)
def yoy_change(spark: SparkSession, folder: str) -> DataFrame:
    cells = sales(spark, folder, ["nation", "year"], {"n": F.lit(1)})
    return ordered.change_over_periods(cells, "nation", "year", "n")


@query(
    "high_high",
    on_lines(
        "SELECT * FROM r WHERE n > (SELECT avg(n) FROM r) AND revenue > (SELECT avg(revenue) FROM r)",
        f", r AS (SELECT nation, {REVENUE_SQL} FROM ev GROUP BY nation)",
    ),
)
def high_high(spark: SparkSession, folder: str) -> DataFrame:
    return olap.above_average(hundredths(revenue(spark, folder, ["nation"]), "revenue"), ["n", "revenue"])


@query(
    "activity_rank",
    """WITH r AS (SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_suppkey),
    k AS (SELECT *, rank() OVER (ORDER BY n DESC) AS rank_n, rank() OVER (ORDER BY quantity DESC) AS rank_quantity,
      rank() OVER (ORDER BY revenue DESC) AS rank_revenue FROM r)
    SELECT *, rank_n + rank_quantity + rank_revenue AS rank_sum,
      rank() OVER (ORDER BY rank_n + rank_quantity + rank_revenue) AS activity_rank FROM k""",
)
def activity_rank(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents("l_quantity")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("revenue"),
    )
    return olap.composite_rank(hundredths(lines, "quantity", "revenue"), ["n", "quantity", "revenue"])
