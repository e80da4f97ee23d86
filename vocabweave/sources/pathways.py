"""Event trees, event details and participants to edges and nodes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.fixed_values import REACTION_TYPE_CODES
from vocabweave.operators.keyed import fair_tasks
from vocabweave.session import cut_lineage
from vocabweave.sources.annotations import valueset_codes
from vocabweave.sources.tables import union_sources

EVENT = "struct<stId:string,type:string,children:array<string>>"
DETAIL = (
    "struct<displayName:string,goBiologicalProcess:string,compartment:array<struct<accession:string>>,"
    "precedingEvent:array<string>>"
)
PARTICIPANT = "array<struct<className:string,databaseName:string,identifier:string>>"


def flatten_trees(trees: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., parent, id, type, depth): every node of JSON trees of any depth.

    Each round parses one level and explodes its children, which stay text until their own
    round, so the work is shared by all trees and no tree is walked in one piece.
    """
    level = trees.select(*keep, F.lit(None).cast("string").alias("parent"), F.col(text).alias("body"))
    done = []
    for depth in count():
        parsed = cut_lineage(level.select(*keep, "parent", F.from_json("body", EVENT).alias("e")), spread=True)
        if parsed.isEmpty():
            break
        done.append(parsed.select(*keep, "parent", F.col("e.stId").alias("id"), F.col("e.type").alias("type"), F.lit(depth).alias("depth")))
        level = parsed.select(*keep, F.col("e.stId").alias("parent"), F.explode("e.children").alias("body"))
    return union_sources(done) if done else parsed.select(*keep, "parent", F.lit("").alias("id"), F.lit("").alias("type"), F.lit(0).alias("depth"))


def _event(name: str):
    return F.concat(F.lit("REACTOME:"), F.col(name))


def tree_edges(events: DataFrame, valueset: DataFrame) -> DataFrame:
    """``isa`` edges to the type's code and edges from parent to child."""
    kinds = valueset_codes(events.select("id", F.col("type").alias("value")), valueset).select(
        _event("id").alias("subject"), F.lit("isa").alias("predicate"), F.col("code").alias("object")
    )
    children = events.where("parent IS NOT NULL").select(
        _event("parent").alias("subject"), F.lit("causally_related_to").alias("predicate"), _event("id").alias("object")
    )
    return kinds.unionByName(children)


def property_edges(events: DataFrame, details: DataFrame) -> DataFrame:
    """Taxon, process, compartment and preceding-event edges of every event.

    ``events`` has (id, taxon), ``details`` has (id, body) with the landed JSON answer.
    """
    # dealt out first: a task that reads much of the events would keep all their ids
    ids = events.select("id", "taxon").repartition(fair_tasks(events, details), "id").distinct()
    taxon = ids.select(_event("id").alias("subject"), F.lit("in_taxon").alias("predicate"), F.concat(F.lit("NCBI:"), F.col("taxon")).alias("object"))
    parsed = details.select("id", F.from_json("body", DETAIL).alias("d")).join(ids.select("id").distinct(), "id", "left_semi")

    def edge(predicate: str, obj):
        return F.struct(F.lit(predicate).alias("predicate"), obj.alias("object"))

    process = F.get_json_object("d.goBiologicalProcess", "$.accession")
    preceding = F.transform("d.precedingEvent", lambda p: F.get_json_object(p, "$.stId"))
    found = F.concat(
        F.when(process.isNotNull(), F.array(edge("involved_in", F.concat(F.lit("GO:"), process)))).otherwise(F.array()),
        F.coalesce(F.transform("d.compartment", lambda c: edge("part_of", F.concat(F.lit("GO:"), c["accession"]))), F.array()),
        F.coalesce(
            F.transform(F.filter(preceding, lambda p: p.isNotNull()), lambda p: edge("preceded_by", F.concat(F.lit("REACTOME:"), p))),
            F.array(),
        ),
    )
    properties = parsed.select(_event("id").alias("subject"), F.explode(found).alias("e")).select("subject", "e.*")
    return taxon.unionByName(properties)


def participant_edges(tree: DataFrame, participants: DataFrame) -> DataFrame:
    """Edges from reaction events to the molecules that take part; (id, body) is landed JSON."""
    reactions = tree.where((F.col("predicate") == "isa") & F.col("object").isin(REACTION_TYPE_CODES)).select("subject")
    reactions = reactions.repartition(fair_tasks(tree, participants), "subject").distinct()
    molecules = participants.select(_event("id").alias("subject"), F.explode(F.from_json("body", PARTICIPANT)).alias("p"))
    sab = F.when(F.col("p.className") == "ReferenceGeneProduct", "UNIPROTKB").otherwise(F.upper("p.databaseName"))
    return molecules.join(reactions, ["subject"], "left_semi").select(
        "subject", F.lit("has_participant").alias("predicate"), F.concat(sab, F.lit(":"), F.col("p.identifier")).alias("object")
    )


def pathway_edges(trees: DataFrame, details: DataFrame, participants: DataFrame, valueset: DataFrame) -> DataFrame:
    """All edges; ``trees`` has (taxon, body)."""
    events = cut_lineage(flatten_trees(trees, "body", ["taxon"]), spread=True)
    tree = tree_edges(events, valueset)
    return union_sources([tree, property_edges(events, details), participant_edges(tree, participants)])


def pathway_nodes(edges: DataFrame, details: DataFrame) -> DataFrame:
    """Nodes of all subjects, labelled with the event's display name."""
    named = details.select(_event("id").alias("node_id"), F.from_json("body", DETAIL)["displayName"].alias("node_label"))
    subjects = edges.select(F.col("subject").alias("node_id")).repartition("node_id").distinct()
    blank = F.lit("")
    return subjects.join(named, "node_id", "left").select(
        "node_id", F.coalesce("node_label", blank).alias("node_label"), blank.alias("node_definition"),
        blank.alias("node_synonyms"), blank.alias("node_dbxrefs"),
    )
