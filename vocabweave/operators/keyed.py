"""Numbering and lists that stay balanced when one key is hot.

A key is *hot* when it holds more rows than a task's fair share (all rows over the number
of shuffle partitions, ``SHARES`` at least) and ``min_rows`` of them. There can be no more
hot keys than shares, whatever the size of the table, so they fit in a broadcast. They are
looked for with one pre-aggregated count; where there are none, the plain Spark plan is used.
Joins need no such care: adaptive execution splits skewed partitions on either side, whatever
the rows look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.session import checkpointed

SHARES = 2000
MIN_HOT_ROWS = 500_000
#: Rows that one task of a join keeps, on average.
TASK_ROWS = 500_000


def key_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int, int]:
    """Rows per key (null keys left out), the number of rows and the size of the largest key."""
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    return counts, total or 0, largest or 0


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """None, or a local table of the keys that hold too many rows for one task.

    ``_salts`` is the number of tasks that give each of them a fair share.
    """
    counts, total, largest = key_sizes(df, keys)
    shares = max(SHARES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fair = max(MIN_HOT_ROWS if min_rows is None else min_rows, total // shares + 1)
    if largest < fair:
        return None
    salts = F.ceil(F.col("_n") / fair).cast("int").alias("_salts")
    hot = counts.where(F.col("_n") >= fair).select(*keys, salts)
    return df.sparkSession.createDataFrame(hot.collect(), hot.schema)


def fair_tasks(*frames: DataFrame) -> int:
    """Tasks that keep ``TASK_ROWS`` of all rows each, so that the memory of a task does not grow with the tables.

    Given to ``repartition`` on one side of a join, both sides are dealt into as many, and
    adaptive execution does not put them together again.
    """
    return sum(frame.count() for frame in frames) // TASK_ROWS + 1


def hashed_side(side: DataFrame) -> DataFrame:
    """``side``, a written table with one row per join key, for a join that need not sort the other side.

    Each task of the join then holds its share of ``side`` in a hash table, so this is done only
    where a share is ``TASK_ROWS`` at most; a table smaller than that is left to the planner,
    which may broadcast it, and a larger one to the sort, which spills.
    """
    rows = side.count()
    shares = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return side.hint("shuffle_hash") if TASK_ROWS < rows <= TASK_ROWS * shares else side


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in ``order``.

    The filter on the row number lets Spark drop all but one row per key before the
    shuffle, so a hot key ships one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(window)).where("_first = 1").drop("_first")


def _sliced(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned by ``order`` and written, with the stable number of their slice."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(df.repartitionByRange(slices, *order)).withColumn("_slice", F.spark_partition_id())


def dense_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows 1..n by ``order``, a total order, without moving them into one task.

    Each range slice is numbered on its own and shifted by the rows before it; only the
    slice sizes, one row per slice, pass through a single task and the broadcast.
    """
    rows = _sliced(df, order)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        rows.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (
        rows.withColumn("_local", local)
        .join(F.broadcast(shift), "_slice")
        .withColumn(name, F.col("_shift") + F.col("_local"))
        .drop("_slice", "_local", "_shift")
    )


def number_within(
    df: DataFrame, key: str, order: Sequence[str], name: str, min_rows: int | None = None
) -> DataFrame:
    """Number the rows of each key 1..n by ``order``; a hot key is numbered slice by slice."""
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("bigint")
    hot = hot_keys(df, [key], min_rows)
    if hot is None:
        return df.withColumn(name, plain)
    hot = F.broadcast(hot.drop("_salts"))
    cold = df.join(hot, key, "left_anti").withColumn(name, plain)

    rows = _sliced(df.join(hot, key, "left_semi"), [key, *order])
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # a hot key spans neighbouring slices, so this has at most (slices + hot keys) rows
    shift = (
        rows.groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    numbered = (
        rows.withColumn("_local", local)
        .join(F.broadcast(shift), [key, "_slice"])
        .withColumn(name, F.col("_shift") + F.col("_local"))
        .drop("_slice", "_local", "_shift")
    )
    return cold.unionByName(numbered)


def list_rows(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """The list of ``value`` per ``key`` as rows (``key``, ``pos`` from 1, ``value``), in ``order``.

    A list of any length stays rows, so none is gathered in one cell or task.
    """
    return number_within(df, key, order, "pos").select(key, "pos", value)
