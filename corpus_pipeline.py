"""Cleans a corpus of documents and encodes it: five stages, each on all rows the one before kept.

A null or empty text is clean, like no other and without tokens. Texts may have any length, and columns beside
``doc_id`` and ``text`` any name; all but the last stage keep them. Rows that are equal count as near duplicates, if
they have words. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabweave.llm import bpe, decontamination, jaccard, repeats, toxicity
from vocabweave.llm.blocks import free_name
from vocabweave.llm.queries import toxicity_model
from vocabweave.session import cut_lineage


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic, by a model of the labelled ones among them."""
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name("toxicity", docs.columns)
    return toxicity.score(docs, model, to=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return jaccard.one_of_each(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place has; their length, where there is such a column, follows the text."""
    kept = repeats.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    rest = [c for c in docs.columns if c != "text"]
    found = decontamination.passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=rest)
    kept = decontamination.contaminated(found).where(~F.col("contaminated"))
    return kept.select(*(F.col("text") if c == "text" else F.col("carried")[c].alias(c) for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of what they decode to, per document."""
    return bpe.digest(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", ordinary),
    ("near_duplicates", distinct),
    ("repeated_passages", unrepeated),
    ("decontamination", uncontaminated),
    ("encoding", encoded),
]

#: Compression distances, connected components and token merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
