"""Edge and node tables with IRIs straight to graph objects, without concept resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import after_last, iri_to_curie, sab_of_code
from vocabweave.functions.fixed_values import RDFS_SUBCLASS
from vocabweave.functions.text import blank_if_null_like, number_or_zero
from vocabweave.operators.keyed import first_per_key
from vocabweave.sources.tables import union_sources


def _items(name: str) -> Column:
    """Items of a pipe list; none for a missing list."""
    text = blank_if_null_like(F.col(name))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\|"))


def oneshot_nodes(nodes: DataFrame) -> DataFrame:
    """(kind, id, pref_term, def, sab): concepts, terms and definitions of every node row."""
    curie = iri_to_curie(F.col("node_id"))
    sab = sab_of_code(curie)
    label = blank_if_null_like(F.col("node_label"))
    definition = blank_if_null_like(F.col("node_definition"))
    blank = F.lit("")

    def entry(kind: str, node_id: Column, pref_term: Column = blank, text: Column = blank, source: Column = sab) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), node_id.alias("id"), pref_term.alias("pref_term"),
            text.alias("def"), source.alias("sab"),
        )

    synonyms = F.transform(F.filter(_items("node_synonyms"), lambda s: s != label), lambda s: entry("Term", s))
    xrefs = F.transform(_items("node_dbxrefs"), lambda c: entry("Concept", c, c, blank, sab_of_code(c)))
    entries = F.concat(
        F.array(entry("Concept", curie, label), entry("Term", label)),
        synonyms,
        F.when(definition != "", F.array(entry("Label_Definition", curie, blank, definition))).otherwise(F.array()),
        xrefs,
    )
    return nodes.select(F.explode(entries).alias("e")).select("e.*")


def relation_definitions(edges: DataFrame, reference_nodes: DataFrame, sab: str) -> DataFrame:
    """(id, def, label, sab) of ISA, CODE and every other predicate, from the reference where known."""
    known = first_per_key(reference_nodes, ["id"], ["ord"]).select(
        F.col("id").alias("predicate"), F.col("lbl").alias("lbl"), F.col("def").alias("text")
    )
    used = edges.select("predicate").where(F.col("predicate") != RDFS_SUBCLASS).distinct()
    rows = used.join(known, "predicate", "left").select(
        F.when(F.col("lbl").isNotNull(), F.replace("predicate", F.lit("_"), F.lit(":"))).otherwise(F.col("predicate")).alias("id"),
        blank_if_null_like(F.col("text")).alias("def"),
        F.coalesce("lbl", "predicate").alias("label"),
        F.lit(sab).alias("sab"),
    )
    fixed = edges.sparkSession.createDataFrame(
        [(f"{sab}:ISA", "Subject is a class of object.", "ISA", sab), (f"{sab}:CODE", "Subject has CODE relationship with object", "CODE", sab)],
        "id string, def string, label string, sab string",
    )
    return fixed.unionByName(rows)


def source_discovery(nodes: DataFrame) -> DataFrame:
    """(id, name, sab): sources of all node ids and cross-references."""
    sabs = F.concat(
        F.array(F.substring_index(after_last(F.col("node_id"), "/"), "_", 1)),
        F.transform(_items("node_dbxrefs"), sab_of_code),
    )
    found = nodes.select(F.explode(sabs).alias("sab")).where("sab <> ''").distinct()
    return found.select(F.concat_ws(":", "sab", "sab").alias("id"), F.col("sab").alias("name"), "sab")


def oneshot_rels(edges: DataFrame, reference_nodes: DataFrame) -> DataFrame:
    """(label, start_id, end_id, evidence_class): edges named by the reference or by their code's tail."""
    known = first_per_key(reference_nodes.where("lbl IS NOT NULL"), ["id"], ["ord"]).select(
        F.col("id").alias("predicate"), "lbl"
    )
    named = edges.join(known, ["predicate"], "left")
    label = F.when(F.col("predicate") == RDFS_SUBCLASS, "ISA").otherwise(F.coalesce("lbl", after_last(F.col("predicate"), "_")))
    evidence = blank_if_null_like(F.col("evidence_class")) if "evidence_class" in edges.columns else F.lit("")
    return named.select(
        label.alias("label"), iri_to_curie(F.col("subject")).alias("start_id"),
        iri_to_curie(F.col("object")).alias("end_id"), evidence.alias("evidence_class"),
    )


def evidence_defaults(nodes: DataFrame) -> list[Column]:
    """Bounds and value as numbers (0 where missing) and the unit (blank where missing)."""
    numbers = [
        (number_or_zero(F.col(name)) if name in nodes.columns else F.lit(0.0)).alias(name)
        for name in ("lowerbound", "upperbound", "value")
    ]
    unit = blank_if_null_like(F.col("unit")) if "unit" in nodes.columns else F.lit("")
    return [*numbers, unit.alias("unit")]


def oneshot_code_rels(nodes: DataFrame, sab: str) -> DataFrame:
    """Links of each node to its label (PT, with evidence) and its synonyms (SYN, without)."""
    curie = iri_to_curie(F.col("node_id")).alias("start_id")
    definition = blank_if_null_like(F.col("node_definition")).alias("def")
    preferred = nodes.select(
        curie, F.col("node_label").alias("end_id"), F.lit("PT").alias("tty"), definition, *evidence_defaults(nodes)
    )
    synonyms = nodes.select(curie, F.explode(_items("node_synonyms")).alias("end_id"), F.lit("SYN").alias("tty"))
    return union_sources([preferred, synonyms]).select("*", F.col("start_id").alias("codeid"), F.lit(sab).alias("sab"))
