"""Every registered query beside its SQL on the smallest driver tables."""

import importlib.util
import os
import sys

import pytest

import __spark_entry__ as entry_points
from quadrata.workload.all import REGISTRY

from . import oracle

FOLDER = os.environ.get("QUADRATA_TESTDATA", "/root/testdata/sf0.001")
# Long model fits; their operators have tests of their own.
SLOW = {"rf_panel"}

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SLOW))
def test_query(spark, con, name):
    assert oracle.differences(spark, con, FOLDER, name) == []


def test_entry_points():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(REGISTRY) - set(entry_points.oracle_sql()) == SLOW | {"pca", "kmeans_sweep", "cluster_profiles", "dbscan_panel"}


@pytest.mark.parametrize("hidden", ["public_tokenizers", "corpus_pipeline", "quadrata.llm", "xxhash"])
def test_other_queries_stay_without_the_optional_package(monkeypatch, hidden):
    for name in list(sys.modules):
        if name.split(".")[0] in ("corpus_pipeline", "public_tokenizers", "xxhash") or name.startswith("quadrata.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, hidden, None)  # importing it raises ImportError
    spec = importlib.util.spec_from_file_location("entry_without", entry_points.__file__)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.queries()) == set(REGISTRY)


@needs_data
def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["nation", "year", "total", "flagged", "not_flagged", "flagged_share"] and df.count() > 0


@needs_data
@pytest.mark.parametrize("name", ["olap_slice", "olap_dice"])
def test_year_filters_reach_the_reader(spark, name):
    plan = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate," in plan and "LessThan(o_orderdate," in plan


@needs_data
@pytest.mark.parametrize("name", ["fact_month_subtype", "star_join"])
def test_literal_dimensions_are_small_in_the_plan(spark, name):
    """Neither a Cartesian product nor a shuffle of the fact on its few classes."""
    plan = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            keys = line.split("hashpartitioning(")[1].split(")")[0]
            assert [k.split("#")[0] for k in keys.split(", ")][:-1] not in (["class"], ["subtype_id"])
