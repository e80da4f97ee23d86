"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabweave.llm import bpe, decontamination, hard_negatives, jaccard, language, licences, neighbours, repeats, resampling, suffix_tree, token_counts, toxicity, twins, url_filters
from vocabweave.llm.blocks import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(plan: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return add


@register("op4_decontamination", twins.DECONTAMINATION)
def op4(table):
    return decontamination.digest(decontamination.passages(table("documents"), table("benchmark")))


@register("op7_byte_bpe")
def op7(table):
    return bpe.digest(table("documents"))


def toxicity_model(documents, labels):
    """Learned from the labelled documents outside the held-out fold."""
    return toxicity.fit(documents.where(fold("doc_id", 3) != 1), labels)


@register("op2_toxicity")
def op2(table):
    documents = table("documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity_model(documents, table("labels")))
    return scored.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@register("op9_licence_scan", licences.oracle())
def op9(table):
    return licences.matches(table("documents"))


@register("op8_url_filter", url_filters.oracle())
def op8(table):
    return url_filters.judge(table("pages"))


@register("op3_nearest_neighbours")
def op3(table):
    return neighbours.nearest(table("embeddings"), F.col("vec_id") % 20 == 0)


@register("op1_ngram_jaccard_join", twins.JACCARD)
def op1(table):
    return jaccard.join(table("documents"))


@register("op10_repeated_passages", twins.REPEATS)
def op10(table):
    return repeats.digest(table("documents"))


@register("op6_language_id")
def op6(table):
    documents = table("documents")
    model = language.fit(documents.where(fold("doc_id", 3) != 1))
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@register("op5_suffix_tree")
def op5(table):
    held_out = fold("doc_id", 5) == 1
    scored = suffix_tree.score(table("documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op12_token_counts")
def op12(table):
    return token_counts.count(table("documents"))


@register("op13_importance_resampling", twins.RESAMPLING)
def op13(table):
    return resampling.resample(table("documents"), table("benchmark"))


@register("op11_hard_negatives", twins.HARD_NEGATIVES)
def op11(table):
    # the labels of every seventh row are moved on by one
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table("embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)
