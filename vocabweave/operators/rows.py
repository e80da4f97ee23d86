"""Whole-row steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_counts(df: DataFrame) -> DataFrame:
    """(rows_before, rows_after) of removing repeated rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum("_n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
