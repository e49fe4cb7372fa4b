"""Checks of the events derive them once."""

import pytest

from quadrata.workload.all import REGISTRY

from .test_queries import FOLDER, needs_data


@needs_data
@pytest.mark.parametrize("name", ["dq_excluded", "dq_report"])
def test_events_are_derived_once(spark, name):
    plan = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "l_returnflag" in line for line in plan.splitlines()) == {"dq_excluded": 1, "dq_report": 2}[name]
