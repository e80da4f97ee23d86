"""What a graph knows already, as tables that a join with a new source need not shuffle."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from vocabweave.sources.tables import Graph

#: The key that each table is bucketed and sorted by.
KEYS = {"codes": "codeid", "concepts": "start_id", "terms": "id"}


@dataclass(frozen=True)
class Known:
    """Codes with their concepts and the place of the link, concepts with a code, and terms; rows may repeat."""

    codes: DataFrame
    concepts: DataFrame
    terms: DataFrame


def known_rows(graph: Graph) -> Known:
    """The rows of ``Known`` that a graph, or the part that a step adds, has."""
    return Known(
        graph.coderels.select("codeid", "start_id", "step", "ord", "pos"),
        graph.coderels.select("start_id").distinct(),
        graph.terms.select("id").distinct(),
    )


def _table(folder: str, name: str) -> str:
    # a name of its own for each folder; the catalog of a session may be in memory only
    return f"known_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def store_known(graph: Graph, folder: str, buckets: int | None = None) -> Known:
    """Write what ``graph`` knows below ``folder``, bucketed by the keys of later joins.

    ``buckets`` is the number of shuffle partitions unless given; with fewer, Spark may prefer
    to shuffle both sides of a join.
    """
    spark = graph.terms.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, key in KEYS.items():
        rows = getattr(known_rows(graph), name).repartition(buckets, key)
        spark.sql(f"DROP TABLE IF EXISTS {_table(folder, name)}")
        writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}")
        writer.mode("overwrite").saveAsTable(_table(folder, name))
    # written last: how a later session has to open the tables
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/buckets")
    return load_known(spark, folder)


def load_known(spark: SparkSession, folder: str) -> Known:
    """The tables below ``folder``, put into the catalog of the session where they are not yet."""
    buckets = spark.read.parquet(f"{folder}/buckets").first().buckets
    schemas = {"codes": "codeid string, start_id string, step int, ord bigint, pos bigint", "concepts": "start_id string", "terms": "id string"}
    for name, key in KEYS.items():
        if not spark.catalog.tableExists(_table(folder, name)):
            spark.sql(
                f"CREATE TABLE {_table(folder, name)} ({schemas[name]}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'"
            )
    return Known(**{f.name: spark.table(_table(folder, f.name)) for f in fields(Known)})


def add_known(added: Graph, folder: str) -> None:
    """Add what a step adds; only these rows are shuffled. Adding them twice changes nothing."""
    spark = added.terms.sparkSession
    load_known(spark, folder)
    buckets = spark.read.parquet(f"{folder}/buckets").first().buckets
    for name, key in KEYS.items():
        rows = getattr(known_rows(added), name).repartition(buckets, key)
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").mode("append").saveAsTable(_table(folder, name))
        spark.catalog.refreshTable(_table(folder, name))
