"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "vocabweave", **conf) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of a row group of rows that a single task may have written.
SPREAD_BYTES = 8 << 20


def cut_lineage(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a frame that reads it.

    A lost executor then costs a re-read, not the whole history; readers take only the
    columns they need, and the planner knows the size. With ``spread``, rows come from files
    that Spark cannot split; they are written in small row groups, so that many tasks read
    what one has written, without a shuffle.
    """
    path = shared_folder(df.sparkSession, "step")
    writer = df.write.option("parquet.block.size", SPREAD_BYTES) if spread else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint, which also keeps its partitions as they are."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_base(df.sparkSession))
    return df.checkpoint(eager=True)


def _shared_base(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session may go without."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vocabweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables beside the checkpoints that all executors share."""
    return f"{_shared_base(spark)}/{name}-{uuid.uuid4().hex}"
