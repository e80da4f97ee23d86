"""Nodes with their missing endpoints are joined whatever adaptive execution makes of the sides of the union."""

import pytest
from pyspark.sql import functions as F

from vocabweave.operators import resolve
from vocabweave.plans.all_queries import QUERIES
from vocabweave.session import cut_lineage

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def broadcast_below(spark):
    before = spark.conf.get(THRESHOLD)
    yield lambda size: spark.conf.set(THRESHOLD, size)
    spark.conf.set(THRESHOLD, before)


def test_whole_nodes_are_joined_again_and_again(spark, broadcast_below):
    key = F.col("id").cast("string")
    blank, blanks = F.lit(""), F.array(F.lit(""))
    nodes = cut_lineage(spark.range(3000).select(
        F.concat(F.lit("N:"), key).alias("node_id"), blank.alias("node_label"), blank.alias("node_definition"),
        blanks.alias("node_synonyms"), blanks.alias("node_dbxrefs"), F.col("id").alias("ord")))
    edges = cut_lineage(spark.range(3000).select(F.concat(F.lit("N:"), key).alias("subject"), F.concat(F.lit("M:"), F.col("id") % 50).alias("object")))
    lists = cut_lineage(spark.range(60_000).select(F.concat(F.lit("N:"), F.col("id") % 3000).alias("node_id"), F.concat(F.lit("C:"), key).alias("cui")))
    broadcast_below("20k")
    whole = resolve.complete_nodes(edges, nodes).select("node_id", "ord")
    assert whole.count() == 3050
    choice = whole.join(lists.groupBy("node_id").agg(F.min("cui").alias("cui")), "node_id", "left")
    lone = choice.groupBy("cui").agg(F.max("node_id").alias("node_id"), F.count(F.lit(1)).alias("n")).where("n = 1").select("node_id")
    in_group = choice.join(lone, "node_id", "left_semi").select("node_id")
    assert lists.join(in_group.join(whole, "node_id"), "node_id").count() == 60_000


def small_tables(spark, folder):
    """Orders of 200 parts, four lines each; every tenth part has the concept of another."""
    n = F.col("id")
    one_of = lambda *values: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("id"), F.lit(len(values))) + 1).cast("int"))
    tables = {
        "region": spark.range(5).select(n.alias("r_regionkey")),
        "nation": spark.range(25).select(n.alias("n_nationkey"), (n % 5).alias("n_regionkey")),
        "customer": spark.range(150).select(n.alias("c_custkey"), (n % 25).alias("c_nationkey")),
        "part": spark.range(200).select(
            n.alias("p_partkey"), F.concat(F.lit("part "), n % 40).alias("p_name"), F.concat(F.lit("Brand#"), n % 9).alias("p_brand"),
            F.lit("LARGE").alias("p_type"), (n % 50 + 1).cast("int").alias("p_size")),
        "orders": spark.range(1500).select(
            n.alias("o_orderkey"), (n * 7 % 150).alias("o_custkey"), one_of("O", "F", "P").alias("o_orderstatus"), one_of("1-URGENT", "5-LOW").alias("o_orderpriority")),
        "lineitem": spark.range(6000).select(
            (n % 1500).alias("l_orderkey"), (F.pmod(F.xxhash64(n), F.lit(200))).alias("l_partkey"), (n * 3 % 10).alias("l_suppkey"),
            (n / 1500 + 1).cast("int").alias("l_linenumber"), one_of("A", "N", "R").alias("l_returnflag"), one_of("O", "F").alias("l_linestatus")),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_greedy_and_lists_are_the_same_by_any_joins(spark, broadcast_below, tmp_path):
    folder = small_tables(spark, tmp_path)
    found = {}
    for size in ("10m", "20k"):
        broadcast_below(size)
        for name in ("preferred_concept_greedy", "cui_lists"):
            found.setdefault(name, []).append(sorted(map(tuple, QUERIES[name](spark, folder).collect())))
    for one, other in found.values():
        assert one == other and len(one) >= 1880
