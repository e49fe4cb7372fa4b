"""Operators against brute force, with gaps, ties and one key that holds a third of all rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrata.functions.text import pin, trim_strings
from quadrata.operators import aggregates as ag
from quadrata.operators import olap, ordered, quality, schema, sets
from quadrata.operators.along import Hop, sum_along
from quadrata.sources.discovery import Signature, discover_sources, merge_metrics, missing_classes


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_weighted_means(spark):
    data = [("a", 1.0, 2.0), ("a", None, 5.0), ("a", 3.0, None), ("b", 4.0, 0.0), ("c", 1.0, None)]
    df = spark.createDataFrame(data, "k string, v double, w double")
    got = rows(ag.weighted_means(df, ["k"], ["v"], "w"))
    assert got == [("a", 3, 7.0, 1.0), ("b", 1, 0.0, None), ("c", 1, 0.0, None)]


def test_wide_counts_keep_all_columns(spark):
    df = spark.createDataFrame([("a", "x")] * 4 + [("b", "z")], "k string, c string")
    got = rows(ag.wide_counts(df, ["k"], "c", {"x": "n_x", "y": "n_y"}, "total", "log"))
    assert got == [("a", 4, 4, 0, pytest.approx(np.log(5))), ("b", 1, 0, 0, pytest.approx(np.log(2)))]


def test_located_counts(spark):
    data = [("a", 1.0, 2.0), ("a", 3.0, 4.0), ("a", 5.0, None), ("b", None, 1.0)]
    df = spark.createDataFrame(data, "k string, lat double, lon double")
    got = rows(ag.located_counts(df, ["k"], "lat", "lon", "n", "m", "x", "y"))
    assert got == [("a", 3, 2, 2.0, 3.0), ("b", 1, 0, None, None)]


def test_null_report_and_counters(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(ag.null_report(df)) == [("a", 1, 2, 0.5), ("b", 2, 2, 1.0)]
    counted = ag.counters(df, {"a_missing": F.col("a").isNull(), "a_one": F.col("a") == 1})
    assert rows(counted) == [(1, 1)]


def test_sum_along_equals_plain_join(spark):
    rng = random.Random(1)
    # Every third line belongs to order 0, and order 0 to customer 0.
    lines = [(0 if i % 3 == 0 else rng.randrange(1, 200), i % 7, i) for i in range(3000)]
    orders = [(o, 0 if o % 3 == 0 else rng.randrange(20), 1990 + o % 4) for o in range(190)]
    customers = [(c, f"n{c % 3}") for c in range(18)]
    fact = spark.createDataFrame(lines, "o int, q int, v int")
    by_order = spark.createDataFrame(orders, "order_key int, c int, year int")
    by_customer = spark.createDataFrame(customers, "customer_key int, nation string")
    hops = [Hop(by_order, "o", "order_key"), Hop(by_customer, "c", "customer_key")]
    got = sum_along(fact, hops, ["nation", "year", "q"], {"n": F.lit(1), "s": F.col("v")})
    plain = (
        fact.join(by_order, fact.o == by_order.order_key)
        .join(by_customer, F.col("c") == F.col("customer_key"))
        .groupBy("nation", "year", "q")
        .agg(F.count(F.lit(1)), F.sum("v"))
    )
    assert rows(got) == rows(plain)


def test_sum_along_folds_before_the_join(spark):
    fact = spark.range(100).select((F.col("id") % 5).alias("o"), F.lit(1).alias("v"))
    dim = spark.createDataFrame([(i, i % 2) for i in range(5)], "k long, g int")
    plan = sum_along(fact, [Hop(dim, "o", "k")], ["g"], {"s": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert "Aggregate" in plan[join:] and "Aggregate" in plan[:join]


def test_dense_key_is_1_to_n_in_order(spark):
    rng = random.Random(2)
    data = sorted({(1 if i % 3 else rng.randrange(9), rng.choice(["x", "y", None]), i) for i in range(900)}, key=str)
    df = spark.createDataFrame(data, "a int, b string, c int").repartition(13)
    numbered = ordered.dense_key(df, ["a", "b", "c"], "id").toPandas()
    want = sorted(data, key=lambda r: (r[0], r[1] is None, r[1] or "", r[2]))
    got = numbered.sort_values("id")
    assert got["id"].tolist() == list(range(1, len(data) + 1))
    assert got["c"].tolist() == [r[2] for r in want]


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.normal(size=501), "b": np.where(np.arange(501) % 3 == 0, 7.0, rng.integers(0, 5, 501))})
    frame.loc[::10, "a"] = None
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in frame.values], "a double, b double")
    for q in (0.5, 0.1, 0.99):
        got = {r.column_name: r.value for r in ordered.exact_quantiles(df, ["a", "b"], q).collect()}
        assert got == {c: pytest.approx(frame[c].quantile(q)) for c in "ab"}


def test_global_ranks_with_ties_and_gaps(spark):
    values = [5, 5, 5, 9, 1, None, 3, 5]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    got = {r.i: r.place for r in ordered.global_rank(df, "v", "place").collect()}
    assert got == {3: 1, 0: 2, 1: 2, 2: 2, 7: 2, 6: 6, 4: 7, 5: 8}


def test_labels_of_ordered_means(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 1.0), (2, 9.0)], "g int, m double")
    got = {r.g: r.risk_label for r in ordered.ordered_labels(df, "g", "m", ["low", "medium", "high"]).collect()}
    assert got == {0: "medium", 1: "low", 2: "high"}


def test_lookup_matches_null_with_null(spark):
    fact = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "b", None)], "i int, k string, c int")
    dim = spark.createDataFrame([(10, "a", None), (11, "a", 5)], "id int, k string, c int")
    got = sets.lookup_null_safe(fact, dim, ["k", "c"], "id").select("i", "id")
    assert {tuple(r) for r in got.collect()} == {(1, 10), (2, 11), (3, None)}


@pytest.mark.parametrize(
    "years,want",
    [((2014, 2016, 2018, 2020), [2016, 2018, 2020]), ((2014, 2016, 2020), [2016, 2020]), ((1999,), [])],
)
def test_common_periods(spark, years, want):
    survey = spark.createDataFrame([(y,) for y in years], "y int")
    counts = spark.createDataFrame([(y,) for y in range(2016, 2026)] * 2, "y int")
    got = sets.common_periods([survey, counts], "y", (2016, 2018, 2020))
    assert [r.y for r in got.orderBy("y").collect()] == want
    if not want:
        with pytest.raises(ValueError):
            sets.require_periods(got)


def test_infer_types(spark):
    data = [("2020-01-01", "t", "1", "7", "0.5", "1", "1.5", "a", None, "1.5"), ("x", "f", "0", "8", "0.1", "2", "2", "1", None, "2")]
    names = ["fecha_x", "hora_x", "es_x", "x_id", "share_x", "edad", "x", "y", "empty", "total_x"]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    got = {r.column_name: r.inferred_type for r in schema.infer_types(df).collect()}
    assert list(got.values()) == [
        "date", "time", "boolean", "integer", "double", "bigint", "double", "text", "text", "double",
    ]


def test_conform_and_schema_checks(spark):
    df = spark.createDataFrame([(1, "x")], "a int, Bad string")
    contract = StructType.fromDDL("b double, a bigint")
    assert rows(schema.conform(df, contract)) == [(None, 1)]
    found = {r.check_name: r.observed for r in quality.schema_checks(df, contract, "t").collect()}
    assert found == {"t.missing_columns": 1, "t.unexpected_columns": 1, "t.wrong_types": 1, "t.bad_names": 1}
    with pytest.raises(ValueError):
        schema.require_columns(df, ["a", "nope"])


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 3, 1, 2), (1, 5, 2, 2), (None, 4, 4, 0)], "k int, total int, a int, b int")
    dim = spark.createDataFrame([(2,)], "k int")
    report = quality.stack(
        [
            quality.row_checks(df, {"range": quality.out_of_range("total", 0, 4), "sum": quality.not_conserved("total", ["a", "b"])}),
            quality.row_checks(df, {"const": quality.not_constant("k", 1)}, quality.WARNING),
            quality.unique_check(df, ["k"], "unique"),
            quality.foreign_key_check(df, dim, "k", "k", "fk"),
            quality.domain_check(df, "b", [2], "domain"),
            quality.set_check(dim, df.select("k").dropna(), "set"),
            quality.balance_check(df, "b", "total", 2, "balance"),
            quality.no_empty_column_check(df, "empty"),
        ]
    )
    assert {r.check_name: r.observed for r in report.collect()} == {
        "range": 1, "sum": 1, "const": 1, "unique": 1, "fk": 1, "domain": 1, "set": 2, "balance": 1, "empty": 0,
    }
    with pytest.raises(RuntimeError, match="unique: 1"):
        quality.raise_on_critical(report)
    quality.raise_on_critical(report.where("severity = 'warning'"))


def test_metrics_and_discovery(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "metric string, value int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "metric string, value int")
    assert rows(merge_metrics(old, new)) == [("a", 1), ("b", 3), ("c", 4)]
    files = spark.createDataFrame(
        [("p1", 10, ["x", "y"]), ("p2", 30, ["x", "y", "z"]), ("p3", 5, ["q"])], "path string, size int, columns array<string>"
    )
    found = discover_sources(files, {"xy": Signature(("x",), ("y", "w")), "r": Signature(("r",))})
    assert rows(found) == [("xy", 30, "p2")]
    assert missing_classes(found, ["xy", "r"]) == ["r"]


def test_olap(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "k string, y int, v int")
    total = olap.rollup(df, ["k", "y"], {"v": F.sum("v")}).where("level_id = 3").first()
    assert total.v == 35
    assert olap.cube(df, ["k", "y"], {"v": F.sum("v")}).where("level_id = 2").count() == 2
    assert rows(olap.cut(df, {"y": (2, 3), "k": ["a", "b"]})) == [("a", 2, 20)]
    assert rows(olap.above_average(df, ["y", "v"])) == [("a", 2, 20)]
    assert rows(ag.matrix(df, "k", "y", [1, 2], "v", "y")) == [("a", 10, 20), ("b", 5, 0)]


def test_pin_keeps_filters_above(spark):
    df = spark.range(10).withColumn("double", F.col("id") * 2)
    plan = pin(df, "double").where("double > 4")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert pin(df, "double").where("double > 4").count() == 7


def test_trim_strings_leaves_other_types(spark):
    df = spark.createDataFrame([("\t a ", 1)], "s string, i int")
    assert rows(trim_strings(df)) == [("a", 1)]
