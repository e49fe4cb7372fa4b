"""Behaviour at the edges: missing values, type suffixes, repeated names, empty catalogues, repeated metrics, too few labels."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrata.functions.names import dedupe_names
from quadrata.operators import ordered, quality, schema, statistics
from quadrata.session import SHUFFLE_CLEANUP, cut_lineage
from quadrata.sources.discovery import merge_metrics


def test_zscore_keeps_missing_values(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0), (2.0, None)], "a double, b double")
    got = statistics.zscore(df, ["a", "b"]).select("a_z", "b_z").collect()
    assert [r.a_z is None for r in got] == [False, True, False, False]
    assert [r.b_z for r in got] == [0.0, 0.0, 0.0, None]
    assert sum(r.a_z for r in got if r.a_z is not None) == pytest.approx(0)


def test_type_suffixes_are_text(spark):
    df = spark.createDataFrame([("12d", "7"), ("5f", "8")], "code string, size string")
    got = {r.column_name: r.inferred_type for r in schema.infer_types(df, rules=()).collect()}
    assert got == {"code": "text", "size": "bigint"}


@pytest.mark.parametrize(
    ("names", "want"),
    [
        (["a", "a", "a_2"], ["a", "a_3", "a_2"]),
        (["a_2", "a", "a", "a"], ["a_2", "a", "a_3", "a_4"]),
        (["A b", "a-b", "a b"], ["a_b", "a_b_2", "a_b_3"]),
    ],
)
def test_names_never_repeat(names, want):
    assert dedupe_names(names) == want and len(set(want)) == len(want)


def test_catalogue_checks_need_something_to_check(spark):
    shape = "feature_name string, feature_role string, temporal_behavior string, recommended_for_modeling boolean"

    def passed(rows):
        checks = quality.catalog_checks(spark.createDataFrame(rows, shape), ["id", "derived_analysis"], ["area"], "static")
        return {r.check_name: r.passed for r in checks.collect()}

    good = [("area", "id", "static", True), ("rate", "derived_analysis", "yearly", False)]
    assert all(passed(good).values())
    assert not passed(good[:1])["catalog_derived_not_recommended"]
    assert not passed(good[1:])["catalog_static_features"]
    assert not passed([("area", "id", None, True), good[1]])["catalog_static_features"]


def test_new_metrics_are_reduced_to_the_latest(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "metric string, value int")
    new = spark.createDataFrame([("a", 3), ("c", 4)], "metric string, value int")
    got = sorted(map(tuple, merge_metrics(old, new).collect()))
    assert got == [("a", 3), ("b", 2), ("c", 4)]


def test_more_groups_than_labels_is_an_error(spark):
    means = spark.createDataFrame([(i, float(i)) for i in range(3)], "g int, m double")
    assert ordered.ordered_labels(means, "g", "m", ("low", "mid", "high")).count() == 3
    with pytest.raises(PySparkException, match="more groups"):
        ordered.ordered_labels(means, "g", "m", ("low", "high")).collect()


def test_cut_lineage_restores_the_session_and_can_be_read_again(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    cut = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
    assert cut.agg(F.sum("count")).first()[0] == cut.groupBy().sum("count").first()[0] == 1000
