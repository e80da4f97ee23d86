"""Folders that are replaced as a whole.

The versions of a folder lie beside it, in ``<folder>.versions``. The manifest there is a table to which
each finished version adds one row, in one file; its last row is the version in force. A write that
stops before that row leaves the former version as it was.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MANIFEST = "number bigint, name string"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}.versions"


def new_folder(path: str) -> str:
    """A folder of its own for the next version of ``path``."""
    return f"{_base(path)}/{uuid.uuid4().hex}"


def _last(spark: SparkSession, path: str) -> tuple[int, str] | None:
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{_base(path)}/manifest")
    except AnalysisException:  # never overwritten
        return None
    row = rows.agg(F.max(F.struct("number", "name")).alias("last")).first()["last"]
    return (row.number, row.name) if row else None


def publish(spark: SparkSession, path: str, folder: str) -> None:
    """Puts the finished version in ``folder`` in force. Of two at a time, the one with the larger name stays."""
    last = _last(spark, path)
    row = ((last[0] if last else 0) + 1, folder.rsplit("/", 1)[1])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{_base(path)}/manifest")


def current(spark: SparkSession, path: str) -> str:
    """The folder of the version in force; ``path`` itself, if it was never overwritten."""
    last = _last(spark, path)
    return f"{_base(path)}/{last[1]}" if last else path


def remove_old(spark: SparkSession, path: str) -> None:
    """Removes the first version, at ``path``, and all others but the one in force.

    Not while another job writes or still reads a former version.
    """
    last = _last(spark, path)
    if last is None:
        return
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = hadoop(_base(path))
    files = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for entry in files.listStatus(base):
        if entry.getPath().getName() not in ("manifest", last[1]):
            files.delete(entry.getPath(), True)
    files.delete(hadoop(path), True)
