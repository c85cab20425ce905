"""Position numbers against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from obsgrid.operators.ordering import with_position


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_positions_are_those_of_a_sort(spark, partitions):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1.5, 2.0, float("nan"), float("-inf")]) if i % 3 else 2.0, "é" * (i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double, s string").repartition(5)
    got = with_position(df, ["v", F.desc("id")], partitions=partitions).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 501))
    expected = df.orderBy("v", F.desc("id")).collect()
    assert [r.id for r in got] == [r.id for r in expected]
    assert with_position(df.where("false"), ["v"]).collect() == []


def test_only_counts_meet_in_one_task(spark):
    plan = with_position(spark.range(1000).withColumn("v", F.rand(1)), ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
