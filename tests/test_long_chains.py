"""Clusters that are long chains take many rounds; the plans of the rounds must not remember one another."""

import random

from quadrata.operators import density


def test_components_of_a_chain_forget_earlier_rounds(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    nodes = spark.range(60).withColumnRenamed("id", "node")
    labels = density.connected_components(nodes, spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint"))
    assert {r.label for r in labels.collect()} == {0} and labels.count() == 60
    assert labels._jdf.queryExecution().optimizedPlan().constraints().size() == 0
