"""Data-quality checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrata.functions.names import is_snake_case
from quadrata.functions.numeric import stamp
from quadrata.functions.text import is_utf8, to_bool
from quadrata.operators import quality as q
from quadrata.operators.aggregates import counters
from quadrata.plans.sources import clean_events
from quadrata.session import load
from quadrata.workload.aggregates import WIDE_SQL, annual_wide
from quadrata.workload.base import (
    CLASS_SQL,
    CLASSES,
    EVENTS,
    OTHER,
    flagged_line,
    on_events,
    on_lines,
    part_classes,
    query,
    raw_events,
    sales,
)


def check_sql(name: str, observed: str, source: str, severity: str = "critical", passed: str | None = None) -> str:
    """SQL of one check row."""
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, {passed or f'({observed}) = 0'} AS passed,"
        f" CAST({observed} AS BIGINT) AS observed {source}"
    )


def both(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_RANGE_SQL = both(
    check_sql("orders.years", "count(*) FILTER (WHERE NOT year(o_orderdate) BETWEEN 1996 AND 2000)", "FROM orders"),
    check_sql("orders.prices", "count(*) FILTER (WHERE NOT o_totalprice BETWEEN 0 AND 1000000)", "FROM orders"),
    check_sql("lineitem.discounts", "count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.1)", "FROM lineitem"),
)


@query("dq_range", _RANGE_SQL)
def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return q.stack(
        [
            q.row_checks(
                orders,
                {
                    "orders.years": q.out_of_range("year", 1996, 2000),
                    "orders.prices": q.out_of_range("o_totalprice", 0, 1_000_000),
                },
            ),
            q.row_checks(load(spark, folder, "lineitem"), {"lineitem.discounts": q.out_of_range("l_discount", 0, 0.1)}),
        ]
    )


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
_LISTED = ", ".join(f"'{s}'" for s in SEGMENTS)
_DOMAIN_SQL = both(
    check_sql("customer.segments", f"count(DISTINCT c_mktsegment) FILTER (WHERE c_mktsegment NOT IN ({_LISTED}))", "FROM customer"),
    check_sql("nation.count", "count(*)", "FROM nation", passed="count(*) = 25"),
    check_sql(
        "nation.customers",
        "count(*)",
        "FROM (SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer)",
    ),
)


@query("dq_domain", _DOMAIN_SQL)
def dq_domain(spark: SparkSession, folder: str) -> DataFrame:
    nation, customer = load(spark, folder, "nation"), load(spark, folder, "customer")
    keys = nation.select(F.col("n_nationkey").alias("key"))
    used = customer.select(F.col("c_nationkey").alias("key")).distinct()
    return q.stack(
        [
            q.domain_check(customer, "c_mktsegment", SEGMENTS, "customer.segments"),
            q.cardinality_check(nation, 25, "nation.count"),
            q.set_check(keys, used, "nation.customers"),
        ]
    )


_EXCLUDED_SQL = both(
    check_sql("flagged.excluded", "count(*) FILTER (WHERE event_class = 'OTHER' AND is_flagged = 1)", "FROM clean"),
    check_sql("flagged.flag", "count(*) FILTER (WHERE is_flagged <> 1)", "FROM clean", "warning"),
)


@query("dq_excluded", on_events(_EXCLUDED_SQL))
def dq_excluded(spark: SparkSession, folder: str) -> DataFrame:
    """The excluded class never carries the flag; rows without the flag are only reported."""
    clean = clean_events(raw_events(spark, folder), EVENTS)
    excluded = (F.col("event_class") == OTHER) & (F.col("is_flagged") == 1)
    bad = {"flagged.excluded": excluded, "flagged.flag": q.not_constant("is_flagged", 1)}
    return q.row_checks(clean, bad, {"flagged.flag": q.WARNING}).select(*q.CHECK_COLUMNS)


@query(
    "dq_notnull",
    both(
        check_sql("lineitem.order", "count(*) FILTER (WHERE l_orderkey IS NULL)", "FROM lineitem"),
        check_sql("lineitem.part", "count(*) FILTER (WHERE l_partkey % 9 = 0)", "FROM lineitem"),
        check_sql("lineitem.empty_columns", "1", ""),
    ),
)
def dq_notnull(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey")).alias("l_partkey"),
        F.lit(None).cast("string").alias("comment"),
    )
    return q.stack(
        [
            q.row_checks(
                lines,
                {"lineitem.order": F.col("l_orderkey").isNull(), "lineitem.part": F.col("l_partkey").isNull()},
            ),
            q.no_empty_column_check(lines, "lineitem.empty_columns"),
        ]
    )


_SUM = " + ".join(CLASSES.values())
_CONSERVED_SQL = both(
    check_sql("wide.conserved", f"count(*) FILTER (WHERE total <> {_SUM})", "FROM w"),
    check_sql("wide.shifted", f"count(*) FILTER (WHERE total + CASE WHEN year = 1997 THEN 1 ELSE 0 END <> {_SUM})", "FROM w"),
)


@query("dq_conservation", on_lines(_CONSERVED_SQL, f", w AS ({WIDE_SQL})"))
def dq_conservation(spark: SparkSession, folder: str) -> DataFrame:
    """Totals equal the sum of the class columns; a copy with one year off by one must fail."""
    wide = annual_wide(spark, folder)
    shifted = wide.withColumn("off", F.col("total") + F.when(F.col("year") == 1997, 1).otherwise(0))
    parts = list(CLASSES.values())
    return q.row_checks(
        shifted, {"wide.conserved": q.not_conserved("total", parts), "wide.shifted": q.not_conserved("off", parts)}
    )


@query(
    "dq_constants",
    both(
        check_sql("stamp.time", "0", ""),
        check_sql("stamp.label", "0", ""),
        check_sql("stamp.flag", "count(*) FILTER (WHERE s_suppkey % 9 = 0)", "FROM supplier"),
    ),
)
def dq_constants(spark: SparkSession, folder: str) -> DataFrame:
    """Stamped columns hold one value; the text flag is wrong for every ninth supplier."""
    flag = F.when(F.col("s_suppkey") % 9 == 0, "no").when(F.col("s_suppkey") % 2 == 0, "TRUE").otherwise("1")
    rows = stamp(load(spark, folder, "supplier"), {"time_id": 199700, "label": "static"}).withColumn("flag", flag)
    return q.row_checks(
        rows,
        {
            "stamp.time": q.not_constant("time_id", 199700),
            "stamp.label": q.not_constant("label", "static"),
            "stamp.flag": ~to_bool("flag"),
        },
    )


def _unique_sql(table: str, *keys: str) -> str:
    columns = ", ".join(keys)
    return check_sql(
        f"{table}.{'_'.join(keys)}",
        "count(*)",
        f"FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)",
    )


UNIQUE = (
    ("lineitem", "l_orderkey", "l_linenumber"),
    ("orders", "o_orderkey"),
    ("events", "user_id", "event_type"),
    ("documents", "text"),
)


@query("dq_unique", both(*[_unique_sql(*u) for u in UNIQUE]))
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    keys = [q.UniqueKey(f"{t}.{'_'.join(columns)}", t, tuple(columns)) for t, *columns in UNIQUE]
    return q.key_checks({t: load(spark, folder, t) for t, *_ in UNIQUE}, keys)


FOREIGN = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
)


@query(
    "dq_fk",
    both(
        *[
            check_sql(f"{f}.{a}>{d}", "count(*)", f"FROM (SELECT {a} FROM {f} WHERE {a} IS NOT NULL EXCEPT SELECT {b} FROM {d})")
            for f, a, d, b in FOREIGN
        ]
    ),
)
def dq_fk(spark: SparkSession, folder: str) -> DataFrame:
    keys = [q.ForeignKey(f"{f}.{a}>{d}", f, a, d, b) for f, a, d, b in FOREIGN]
    names = {t for f, _, d, _ in FOREIGN for t in (f, d)}
    return q.key_checks({t: load(spark, folder, t) for t in sorted(names)}, keys)


@query(
    "dq_utf8",
    both(
        check_sql("documents.utf8", "0", ""),
        check_sql("documents.broken", "count(*) FILTER (WHERE doc_id % 10 = 0)", "FROM documents"),
        check_sql("pages.utf8", "0", ""),
    ),
)
def dq_utf8(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are valid UTF-8; a copy with a stray byte in every tenth document must fail."""
    raw = F.encode("text", "UTF-8")
    broken = F.when(F.col("doc_id") % 10 == 0, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    documents = load(spark, folder, "documents").select(raw.alias("raw"), broken.alias("broken"))
    pages = load(spark, folder, "pages").select(F.encode("html", "UTF-8").alias("raw"))
    return q.stack(
        [
            q.row_checks(documents, {"documents.utf8": ~is_utf8("raw"), "documents.broken": ~is_utf8("broken")}),
            q.row_checks(pages, {"pages.utf8": ~is_utf8("raw")}),
        ]
    )


@query(
    "dq_names",
    """WITH v AS (SELECT 'p_name' AS source, p_name AS name FROM part UNION SELECT 'p_type', lower(p_type) FROM part
      UNION SELECT 'o_orderpriority', o_orderpriority FROM orders UNION SELECT 'event_type', event_type FROM events)
    SELECT source, count(*) AS n_names, count(*) FILTER (WHERE NOT regexp_matches(name, '^[a-z][a-z0-9_]*$')) AS bad_names
    FROM v GROUP BY source""",
)
def dq_names(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values that would serve as column names, and how many are not snake_case."""

    def names(table: str, column: str, value=None) -> DataFrame:
        rows = load(spark, folder, table).select(F.lit(column).alias("source"), (value or F.col)(column).alias("name"))
        return rows.distinct()

    every = names("part", "p_name").unionByName(names("part", "p_type", F.lower))
    every = every.unionByName(names("orders", "o_orderpriority")).unionByName(names("events", "event_type"))
    return every.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_names"), F.count_if(~is_snake_case("name")).alias("bad_names")
    )


CONTRACTS = {
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", ("c_custkey",)),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string, o_comment string",
        ("o_orderkey",),
    ),
    "events": ("event_id bigint, ts timestamp_ntz, user_id int, event_type string, value double, props string", ("event_id",)),
}


@query(
    "dq_contract",
    both(
        *[
            check_sql(f"{t}.{kind}", str(n), "")
            for t, found in {"customer": (0, 0, 0, 0), "orders": (1, 0, 0, 0), "events": (0, 0, 1, 0)}.items()
            for kind, n in zip(("missing_columns", "unexpected_columns", "wrong_types", "bad_names"), found)
        ],
        _unique_sql("customer", "c_custkey"),
        _unique_sql("orders", "o_orderkey"),
        _unique_sql("events", "event_id"),
        check_sql("part.missing", "0", ""),
        check_sql("returns.missing", "1", ""),
    ),
)
def dq_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Columns, types, names and primary keys against declared contracts, and tables that must exist."""
    from quadrata.sources.layers import path_exists

    checks = []
    for table, (ddl, key) in CONTRACTS.items():
        df = load(spark, folder, table)
        checks.append(q.schema_checks(df, StructType.fromDDL(ddl), table))
        checks.append(q.unique_check(df, key, f"{table}.{'_'.join(key)}"))
    gone = [(t, not path_exists(spark, f"{folder.rstrip('/')}/{t}.parquet")) for t in ("part", "returns")]
    rows = [(f"{t}.missing", q.CRITICAL, not lost, int(lost)) for t, lost in gone]
    existence = spark.createDataFrame(rows, "check_name string, severity string, passed boolean, observed bigint")
    return q.stack([*checks, existence])


_IN = "lat BETWEEN 0.02 AND 0.08 AND lon BETWEEN 0.01 AND 0.07"


@query(
    "coord_quality",
    on_events(
        f"""SELECT count(*) FILTER (WHERE lat IS NOT NULL AND {_IN}) AS inside,
        count(*) FILTER (WHERE lat IS NOT NULL AND NOT ({_IN})) AS outside,
        count(*) FILTER (WHERE lat IS NULL) AS missing FROM clean"""
    ),
)
def coord_quality(spark: SparkSession, folder: str) -> DataFrame:
    clean = clean_events(raw_events(spark, folder), EVENTS)
    outside = q.outside_box("lat", "lon", EVENTS.lat_range, EVENTS.lon_range)
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return counters(clean, {"inside": located & ~outside, "outside": outside, "missing": ~located})


_BALANCE = "SELECT year, count(DISTINCT nation) AS k FROM ev WHERE NOT (year = 2001 AND nation = 'NATION_7') GROUP BY year"


@query(
    "panel_balance",
    on_lines(check_sql("panel.balanced", "count(*) FILTER (WHERE k <> 25)", f"FROM ({_BALANCE})")),
)
def panel_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Periods that lack a nation; one nation is taken out of one year."""
    cells = sales(spark, folder, ["nation", "year"], {"n": F.lit(1)})
    thinned = cells.where(~((F.col("year") == 2001) & (F.col("nation") == "NATION_7")))
    return q.balance_check(thinned, "year", "nation", 25, "panel.balanced")


@query(
    "catalog_rules",
    both(
        check_sql("catalog_roles_complete", "6 - count(DISTINCT class)", f"FROM (SELECT {CLASS_SQL} AS class FROM part) WHERE class <> 'OTHER'"),
        check_sql("catalog_static_features", "count(*) FILTER (WHERE p_name IN ('hot rod', 'old ring') AND p_size % 50 = 0)", "FROM part"),
        check_sql(
            "catalog_derived_not_recommended",
            "count(*) FILTER (WHERE class = 'DEVICE' AND p_retailprice > 1000)",
            f"FROM (SELECT {CLASS_SQL} AS class, p_retailprice FROM part)",
        ),
    ),
)
def catalog_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as catalogue entries: class as role, type of size as temporal behaviour, price as recommendation."""
    part = load(spark, folder, "part").join(part_classes(spark, folder), "p_partkey")
    entries = part.select(
        F.col("p_name").alias("feature_name"),
        F.col("class").alias("feature_role"),
        F.when(F.col("p_size") % 50 == 0, "annual").otherwise("static").alias("temporal_behavior"),
        (F.col("p_retailprice") > 1000).alias("recommended_for_modeling"),
    )
    return q.catalog_checks(entries, list(CLASSES), ["hot rod", "old ring"], "static", derived_role="DEVICE")


@query(
    "dq_report",
    on_events(
        f"""SELECT severity, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed
        FROM ({_RANGE_SQL} UNION ALL {_DOMAIN_SQL} UNION ALL {_EXCLUDED_SQL}) GROUP BY severity"""
    ),
)
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return q.summary(q.stack([dq_range(spark, folder), dq_domain(spark, folder), dq_excluded(spark, folder)]))


VALIDATION = """
 SELECT 'nation_count' AS check_name, 'all' AS item, count(*) AS value FROM {nation}
 UNION ALL SELECT 'class_count', 'all', count(DISTINCT class) FROM {classes} WHERE class <> 'OTHER'
 UNION ALL SELECT 'panel_rows', 'all', count(*) FROM {panel}
 UNION ALL SELECT 'entities_by_year', CAST(year AS STRING), count(DISTINCT nation) FROM {panel} GROUP BY year
 UNION ALL SELECT 'years_outside', 'all', count(*) FROM {panel} WHERE year NOT BETWEEN 1996 AND 2000
 UNION ALL SELECT 'excluded_rows', 'all', count(*) FROM {classes} WHERE class = 'OTHER'
 UNION ALL SELECT 'snapshot_rows', 'all', count(*) FROM {supplier} WHERE (s_acctbal > 0) IS TRUE AND s_nationkey = 3
 UNION ALL SELECT 'without_part', 'all', count(*) FROM {lineitem} l LEFT JOIN {part} p ON p.p_partkey = l.l_partkey
  WHERE p.p_partkey IS NULL
 UNION ALL SELECT 'rows_by_class', class, count(*) FROM {classes} GROUP BY class"""


@query(
    "sql_validation",
    on_lines(
        VALIDATION.replace("STRING", "VARCHAR")
        .replace("{classes}", f"(SELECT {CLASS_SQL} AS class FROM part)")
        .replace("{panel}", "(SELECT DISTINCT nation, year FROM ev)")
        .replace("{part}", "(SELECT * FROM part WHERE p_size <= 45)")
        .replace("{", "")
        .replace("}", "")
    ),
)
def sql_validation(spark: SparkSession, folder: str) -> DataFrame:
    """The nine validation statements as SQL over the layers."""
    return spark.sql(
        VALIDATION,
        nation=load(spark, folder, "nation"),
        classes=part_classes(spark, folder),
        panel=sales(spark, folder, ["nation", "year"], {"n": flagged_line()}),
        supplier=load(spark, folder, "supplier"),
        lineitem=load(spark, folder, "lineitem"),
        part=load(spark, folder, "part").where("p_size <= 45"),
    )
