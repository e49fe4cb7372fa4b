"""Events are kept or dropped before the rest is derived, lines never move by customer, and quick tests change no value."""

import datetime as dt

from pyspark.sql import functions as F

from quadrata.functions import dates, text
from quadrata.functions.entities import EntityCatalog
from quadrata.plans.sources import clean_events, derive_events, valid_events
from quadrata.workload.base import EVENTS, raw_events

from .test_queries import FOLDER, needs_data


def plan_of(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


@needs_data
def test_rows_are_kept_before_they_are_described(spark):
    raw = raw_events(spark, FOLDER)
    plan = plan_of(clean_events(raw, EVENTS))
    kept = next(i for i, line in enumerate(plan) if "Filter" in line and "isnotnull(entity_key" in line)
    described = [i for i, line in enumerate(plan) if "PROMO_METAL" in line]
    assert described and max(described) < kept
    late, early = valid_events(derive_events(raw, EVENTS), EVENTS), clean_events(raw, EVENTS)
    assert late.columns == early.columns
    assert late.exceptAll(early).isEmpty() and early.exceptAll(late).isEmpty() and not early.isEmpty()


@needs_data
def test_lines_do_not_move_by_customer(spark):
    plan = plan_of(raw_events(spark, FOLDER))
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    join = next(i for i, line in enumerate(plan) if "Join" in line and "o_custkey" in line)
    below = [line for line, d in zip(plan[join + 1 :], depth[join + 1 :]) if d > depth[join]]
    assert not any("l_orderkey" in line for line in below)


def test_blanks_of_a_column_are_trimmed_on_both_sides(spark):
    ends = ["", "a", "~", "!", "é", "\x7f", *text.WHITESPACE]
    raw = [None, *{a + m + b for a in ends for b in ends for m in ("", "x", "x y", "　", "é~")}]
    df = spark.createDataFrame([(r,) for r in raw], "`a.b` string")
    both = df.select(F.col("`a.b`").alias("raw"), text.strip_spaces("`a.b`").alias("t")).collect()
    assert sorted(str(r[0]) for r in text.trim_strings(df).collect()) == sorted(str(r.t) for r in both)
    assert [r for r in both if r.t != (None if r.raw is None else r.raw.strip(text.WHITESPACE))] == []


def test_text_keys_in_steps_agree_with_the_expression(spark):
    parts = ["", " ", "  ", "A", "b", "7", "-", "é", "Nátion", "ß", "½", "漢", "한", "\n", "_"]
    df = spark.createDataFrame([(None,), *[(a + b + c,) for a in parts for b in parts for c in parts]], "t string")
    both = text.with_text_keys(df, {"a": "t"}).withColumn("b", text.text_key("t")).collect()
    assert [tuple(r) for r in both if r.a != r.b] == []
    catalog = EntityCatalog(keys=("A", "A B"), codes={7: "A B"}, aliases={"A": "A", "A B": "A B"}, affixes=("B",))
    pairs = df.select("t", F.reverse("t").alias("u"))
    found = catalog.with_canonical(pairs, "a", "t", "u", also={"k": "u"}).withColumn("b", catalog.first_canonical("t", "u"))
    assert [tuple(r) for r in found.collect() if r.a != r.b] == []


def test_dates_in_steps_agree_with_the_expression(spark):
    cases = {
        "1996-01-02": dt.date(1996, 1, 2), "1996-1-2": dt.date(1996, 1, 2), "1996": dt.date(1996, 1, 1), "1677-12-31": None,
        "1678-01-01": dt.date(1678, 1, 1), "2261-12-31": dt.date(2261, 12, 31), "2262-01-01": None, "31/12/1996": None, None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = dates.with_dates(df, {"d": "t"}).select("i", "d", dates.parse_date("t").alias("e"), dates.iso_date("d").alias("s")).orderBy("i").collect()
    assert [r.d for r in got] == [r.e for r in got] == list(cases.values())
    assert [r.s for r in got] == [None if d is None else d.isoformat() for d in cases.values()]
