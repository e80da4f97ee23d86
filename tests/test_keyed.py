"""Hot keys: joins are split, and the sliced plans give the rows of the plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from vocabweave.operators import keyed


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(50)}", i, rng.random()) for i in range(3000)]
    return spark.createDataFrame(rows, "key string, n bigint, x double").repartition(8)


def test_only_large_keys_are_hot(skewed):
    assert [tuple(r) for r in keyed.hot_keys(skewed, ["key"], 300).collect()] == [("hot", 4)]
    assert keyed.hot_keys(skewed, ["key"]) is None


def skew_split(joined):
    """Whether adaptive execution split a skewed partition of the join."""
    joined.collect()
    return "skewed=true" in joined._jdf.queryExecution().executedPlan().toString() or "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_adaptive_execution_splits_hot_keys(spark, how):
    """Equal rows, rows that differ in a map alone, and a hot right side: no salt is needed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        equal = spark.range(0, 30_000, 1, 8).select(key.alias("key"), F.lit("x" * 20).alias("x"))
        maps = spark.range(0, 30_000, 1, 8).select(key.alias("key"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
        side = spark.range(0, 50).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("y")).union(spark.createDataFrame([("hot", 1)], "key string, y int"))
        for left in (equal, maps):
            assert skew_split(left.join(side, ["key"], how))
        if how == "inner":
            assert skew_split(side.join(equal, ["key"]))
    finally:
        for key in conf:
            spark.conf.unset(key)


@pytest.mark.parametrize("min_rows", [None, 500, 1])
def test_number_within(skewed, min_rows):
    rows = keyed.number_within(skewed, "key", ["x", "n"], "place", min_rows=min_rows).collect()
    assert len(rows) == 3000
    groups = {}
    for row in rows:
        groups.setdefault(row.key, []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r.x, r.n))
        assert [r.place for r in members] == list(range(1, len(members) + 1))


def test_dense_number(skewed):
    rows = keyed.dense_number(skewed, ["key", "n"], "place").collect()
    rows.sort(key=lambda r: (r.key, r.n))
    assert [r.place for r in rows] == list(range(1, 3001))


def test_long_lists_stay_rows(skewed):
    rows = keyed.list_rows(skewed, "key", "n", ["n"]).collect()
    expected = {}
    for row in skewed.collect():
        expected.setdefault(row.key, []).append(row.n)
    assert sorted((r.key, r.pos, r.n) for r in rows) == sorted((k, i, n) for k, own in expected.items() for i, n in enumerate(sorted(own), 1))


def test_first_per_key_drops_rows_before_the_shuffle(skewed):
    plan = keyed.first_per_key(skewed, ["key"], ["n"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan
