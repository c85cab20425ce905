"""Bracketed selection of exact quantiles, for groups too large to be walked as they are."""

import random

import pytest
from pyspark.sql import functions as F

from obsgrid.operators import quantiles as Q

PROBS = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)


@pytest.fixture()
def large(monkeypatch):
    """Every group is a large one."""
    monkeypatch.setattr(Q, "DIRECT_ROWS", 0)
    monkeypatch.setattr(Q, "SMALL_GROUP", 20)
    return monkeypatch


def values(spark):
    rng = random.Random(8)
    rows = [("hot", rng.gauss(0, 5)) for _ in range(12_000)] + [("ties", float(rng.choice([1, 1, 1, 2, 7]))) for _ in range(3000)]
    rows += [("odd", rng.choice([float("nan"), float("inf"), float("-inf"), 0.0, 1.5])) for _ in range(400)]
    rows += [("few", float(i * i)) for i in range(7)] + [("one", 4.0), (None, 2.0), (None, 3.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def compared(spark, **more):
    vals = values(spark)
    names = [f"p{i}" for i in range(len(PROBS))]
    found = {r.g: tuple(map(repr, r[1:])) for r in Q.exact_quantiles(vals, ["g"], PROBS, "v", names, **more).collect()}
    expected = vals.groupBy("g").agg(F.count("*").alias("n"), F.percentile("v", list(PROBS)).alias("q")).collect()
    return found, {r.g: (repr(r.n), *map(repr, r.q)) for r in expected}


@pytest.mark.parametrize("slices", [None, 6])
def test_brackets_give_the_exact_quantiles(spark, large, slices):
    found, expected = compared(spark, slices=slices)
    assert found == expected


def test_ranks_outside_their_brackets_are_done_again(spark, large):
    large.setattr(Q, "BRACKET", 0.0)
    large.setattr(Q, "SKETCH_ACCURACY", 3)
    found, expected = compared(spark)
    assert found == expected


def test_groups_beyond_a_broadcast_and_a_walk(spark, large):
    large.setattr(Q, "BROADCAST_GROUPS", 0)
    large.setattr(Q, "WALKED_ROWS", 0)
    found, expected = compared(spark)
    assert found == expected


def test_few_of_the_values_are_sorted(spark, large):
    seen, walked = [], Q._walked
    large.setattr(Q, "_walked", lambda counts, *a: seen.append(counts.where("g = 'hot'").count()) or walked(counts, *a))
    vals = spark.createDataFrame([("hot", random.Random(i).random()) for i in range(40_000)], "g string, v double")
    vals = vals.withColumn("g", F.coalesce("g", F.lit("")))     # keys that can't be NULL stay columns
    Q.exact_quantiles(vals, ["g"], (0.25, 0.5, 0.75), "v").collect()
    assert len(seen) == 1 and seen[0] < 0.05 * 40_000
