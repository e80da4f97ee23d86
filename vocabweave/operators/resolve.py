"""From source nodes to concepts: cross-references, ranked choice, shared concepts.

Lists are kept as rows (one cross-reference or concept per row), so no step gathers a
node's or a concept's rows into one value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.functions.codes import clean_concept_id, standardize_dbxref
from vocabweave.operators.keyed import first_per_key, hot_keys, number_within
from vocabweave.session import cut_lineage, shared_folder

# ranks of a concept for a node, best first
DIRECT, VIA_UMLS, VIA_OTHER, OWN, MINTED, ASSIGNED = 1, 2, 3, 4, 5, 6
#: List rows of a group of nodes that one task walks; they pass through it in order and are not gathered.
GROUP_ROWS = 1_000_000
PICKED = "node_id string, cui string"
CHOICE = ["rank", "xref_ord", "step", "ord", "pos"]
#: How many concepts the list of a node has, and whether the node itself is among them.
LIST_FACTS = ["n_listed", "lists_itself"]


def edge_ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("subject").alias("node_id")).union(edges.select("object")).distinct()


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge endpoints that the node table does not define."""
    return edge_ends(edges).join(nodes.select("node_id").distinct(), "node_id", "left_anti")


def complete_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """First row per node id, plus a row labelled with its id for every missing node.

    Endpoints meet the ids of the nodes only, so no node row is sorted among them; a null
    endpoint is missing where no node has a null id.

    The missing ids are written: were both sides of the union shuffled by the node id, Spark 4.1
    would join it without a shuffle of its own, and fail ("Can't zip RDDs") where adaptive
    execution then reads the sides otherwise. So they are also worked out only once.
    """
    blank = F.lit("")
    ends, defined = edge_ends(edges), nodes.select(F.col("node_id").alias("_defined"))
    missing = cut_lineage(ends.join(defined, F.col("node_id").eqNullSafe(F.col("_defined")), "left_anti")).select(
        "node_id",
        F.col("node_id").alias("node_label"),
        blank.alias("node_definition"),
        F.array(blank).alias("node_synonyms"),
        F.array(blank).alias("node_dbxrefs"),
        F.lit(2**62).alias("ord"),
    )
    whole = first_per_key(nodes, ["node_id"], ["ord"]).unionByName(missing, allowMissingColumns=True)
    return whole.na.fill("", [c for c, kind in whole.dtypes if kind == "string" and c != "node_id"])


def xref_rows(nodes: DataFrame) -> DataFrame:
    """One row per cross-reference in its standard form; blanks dropped before any join."""
    return (
        nodes.select("node_id", F.posexplode("node_dbxrefs").alias("xref_ord", "dbxref"))
        .where("dbxref <> ''")
        .withColumn("xref", standardize_dbxref(F.col("dbxref")))
        .select("node_id", F.col("xref_ord").cast("bigint").alias("xref_ord"), "xref")
    )


def transitive_concepts(xrefs: DataFrame, coderels: DataFrame) -> DataFrame:
    """Concepts that existing codes give to the nodes which refer to them.

    ``coderels`` are links, or only their columns codeid, start_id, step, ord and pos.
    """
    links = concept_of_code(coderels).withColumnRenamed("codeid", "xref")
    umls_concept = F.col("start_id").startswith("UMLS")
    umls_xref = F.upper("xref").startswith("UMLS")
    return (
        xrefs.join(links, ["xref"])
        .where(~(umls_concept & umls_xref))
        .withColumn("rank", F.when(umls_concept, VIA_UMLS).otherwise(VIA_OTHER))
        .select("node_id", "rank", "xref_ord", "step", "ord", "pos", F.col("start_id").alias("cui"))
    )


def concept_of_code(coderels: DataFrame) -> DataFrame:
    """Distinct (code, concept) pairs with the place of their first link."""
    return coderels.groupBy("codeid", "start_id").agg(
        F.min(F.struct("step", "ord", "pos")).alias("place")
    ).select("codeid", "start_id", "place.*")


def direct_concepts(xrefs: DataFrame) -> DataFrame:
    """UMLS concepts named by the cross-reference itself."""
    none = F.lit(0).cast("bigint")
    return xrefs.where(F.lower("xref").startswith("umls:")).select(
        "node_id", F.lit(DIRECT).alias("rank"), "xref_ord",
        F.lit(0).alias("step"), none.alias("ord"), none.alias("pos"), F.upper("xref").alias("cui"),
    )


def existing_concepts(node_ids: DataFrame, coderels: DataFrame, concepts: DataFrame | None = None) -> DataFrame:
    """Concept that a node already has: its code's first one, else the node is a concept.

    Both are looked up by the node id, so the nodes are shuffled once, and the links not at
    all where they are bucketed. ``concepts`` (start_id) are the concepts of ``coderels``.
    """
    place = F.struct("step", "ord", "pos", F.col("start_id").alias("cui"))
    as_code = coderels.groupBy(F.col("codeid").alias("node_id")).agg(F.min(place).alias("own"))
    itself = (coderels if concepts is None else concepts).select(F.col("start_id").alias("node_id")).distinct().withColumn("known", F.lit(True))
    found = node_ids.select("node_id").join(as_code, "node_id", "left").join(itself, "node_id", "left")
    none = F.lit(0).cast("bigint")
    return found.where("own IS NOT NULL OR known").select(
        "node_id", F.lit(OWN).alias("rank"), none.alias("xref_ord"),
        F.coalesce("own.step", F.lit(0)).alias("step"), F.coalesce("own.ord", none).alias("ord"), F.coalesce("own.pos", none).alias("pos"),
        F.coalesce("own.cui", "node_id").alias("cui"),
    )


def candidate_concepts(node_ids: DataFrame, xrefs: DataFrame, coderels: DataFrame, concepts: DataFrame | None = None) -> DataFrame:
    """All concepts of each node with their rank and place; a node without any has no row."""
    found = (
        direct_concepts(xrefs)
        .unionByName(transitive_concepts(xrefs, coderels))
        .unionByName(existing_concepts(node_ids, coderels, concepts))
    )
    return found.withColumn("cui", clean_concept_id(F.col("cui")))


def ranked_choice(node_ids: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best concept per node; the node's own code is minted where there is none."""
    best = candidates.groupBy("node_id").agg(F.min(F.struct(*CHOICE, "cui")).alias("best"))
    return node_ids.select("node_id").join(best, "node_id", "left").select(
        "node_id",
        F.coalesce("best.rank", F.lit(MINTED)).alias("rank"),
        F.coalesce("best.cui", F.col("node_id")).alias("cui"),
    )


def listed_choice(node_ids: DataFrame, listed: DataFrame) -> DataFrame:
    """``ranked_choice`` from lists that are numbered already, with what else their first rows tell (``LIST_FACTS``)."""
    best = listed.where("pos = 1").select("node_id", "rank", "cui", *LIST_FACTS)
    return node_ids.select("node_id").join(best, "node_id", "left").select(
        "node_id", F.coalesce("rank", F.lit(MINTED)).alias("rank"), F.coalesce("cui", F.col("node_id")).alias("cui"), *LIST_FACTS
    )


def shared_concepts(choice: DataFrame) -> DataFrame:
    """Concepts that are the first choice of several nodes."""
    return choice.groupBy("cui").agg(F.count(F.lit(1)).alias("n_nodes")).where("n_nodes > 1")


def resolve_shared(choice: DataFrame) -> DataFrame:
    """Nodes that share their first choice fall back to their own code.

    A concept chosen once names its only node, so the unshared nodes come straight out of
    the count and no row ever meets the other nodes of its concept.
    """
    lone = (
        choice.groupBy("cui")
        .agg(F.count(F.lit(1)).alias("n"), F.max("node_id").alias("node_id"))
        .where("n = 1")
        .select("node_id", F.lit(True).alias("lone"))
    )
    return choice.join(lone, "node_id", "left").select(
        "node_id",
        "rank",
        F.col("cui").alias("first_cui"),
        F.when(F.col("lone"), F.col("cui")).otherwise(F.col("node_id")).alias("assigned_cui"),
        F.when(F.col("lone"), F.lit("default"))
        .otherwise(F.concat(F.lit("own code: shares "), F.col("cui")))
        .alias("assignment_comment"),
        *[name for name in LIST_FACTS if name in choice.columns],
    )


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First free concept of each node, group after group in node order; only the concepts taken in a group are kept."""
    grp, last, seeks, taken = None, None, False, set()
    for rows in batches:
        picked = []
        for of, node, cui in zip(rows["grp"].tolist(), rows["node_id"].tolist(), rows["cui"].tolist()):
            if of != grp:
                grp, last, taken = of, None, set()
            if node != last:
                last, seeks = node, True
            if seeks and cui not in taken:
                seeks = False
                if cui is not None:
                    taken.add(cui)
                    picked.append((node, cui))
        yield pd.DataFrame(picked, columns=["node_id", "cui"], dtype="object")


def _offers_round(offers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node_id, cui) that are settled for good, and the offers that are still open, after one round.

    Each node asks for its best open concept and each concept keeps the earliest node that asks.
    Only an earlier node can take a concept away again, so the nodes before the first one that
    was turned down are settled, and a group without any such node is done.
    """
    asked = cut_lineage(
        offers.groupBy("node_id").agg(F.min(F.struct("pos", "cui", "grp", "ord")).alias("o")).select("node_id", "o.*")
    )
    kept = asked.groupBy("grp", "cui").agg(F.min(F.struct("ord", "node_id")).alias("k")).select("grp", "cui", "k.*")
    refused = cut_lineage(asked.join(kept.select("node_id"), "node_id", "left_anti"))
    first_refused = refused.groupBy("grp").agg(F.min(F.struct("ord", "node_id")).alias("bar"))
    settled = cut_lineage(
        kept.join(first_refused, ["grp"], "left")
        .where(F.col("bar").isNull() | (F.struct("ord", "node_id") < F.col("bar")))
        .select("grp", "node_id", "cui")
    )
    still_open = (
        offers.join(refused.select("node_id", "cui"), ["node_id", "cui"], "left_anti")
        .join(settled.select("node_id"), ["node_id"], "left_anti")
        .join(settled.select("grp", "cui"), ["grp", "cui"], "left_anti")
    )
    return settled.select("node_id", "cui"), still_open


def resolve_shared_greedy(choice: DataFrame, lists: DataFrame, node_ord: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Nodes that share a first choice take, in node order, the first concept still free.

    A group (the nodes of one first choice) with at most ``group_rows`` open list rows is walked
    by one task. In larger ones every node makes offers, round by round, until the group is done
    or what is open is small enough to be walked; both end in the same place. A node that was
    turned down everywhere mints its code. Nodes of one ``ord`` come in the order of their ids.

    ``lists`` holds (node_id, pos, cui), ``node_ord`` holds (node_id, ord).
    """
    spark = choice.sparkSession
    shared = shared_concepts(choice).select("cui")
    in_group = choice.join(shared, ["cui"], "left_semi").select("node_id", F.col("cui").alias("grp"))
    offers = cut_lineage(
        lists.select("node_id", "pos", "cui").join(in_group.join(node_ord, "node_id"), ["node_id"])
    )
    settled = shared_folder(spark, "settled")
    for number in count():
        small = offers.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= group_rows).select("grp")
        queue = offers.join(small, ["grp"], "left_semi").where("node_id IS NOT NULL AND ord IS NOT NULL")
        ordered = queue.repartition("grp").sortWithinPartitions("grp", "ord", "node_id", "pos")
        walked = ordered.select("grp", "node_id", "cui").mapInPandas(_walk, PICKED)
        walked.write.parquet(f"{settled}/part={2 * number}")
        large = cut_lineage(offers.join(small, ["grp"], "left_anti"))
        if large.isEmpty():
            break
        done, still_open = _offers_round(large)
        done.write.parquet(f"{settled}/part={2 * number + 1}")
        offers = cut_lineage(still_open)
    picked = spark.read.schema(PICKED).parquet(f"{settled}/part=*")
    grouped = in_group.join(picked, "node_id", "left").select(
        "node_id", F.coalesce("cui", F.col("node_id")).alias("greedy_cui")
    )
    return choice.join(grouped, "node_id", "left").select(
        "node_id",
        "rank",
        F.col("cui").alias("first_cui"),
        F.coalesce("greedy_cui", "cui").alias("assigned_cui"),
        F.when(F.col("greedy_cui").isNull(), F.lit("default"))
        .otherwise(F.concat(F.lit("first free concept: shares "), F.col("cui")))
        .alias("assignment_comment"),
        *[name for name in LIST_FACTS if name in choice.columns],
    )


def concept_rows(candidates: DataFrame) -> DataFrame:
    """Distinct concepts per node with the place of the best one of equal ones."""
    return candidates.groupBy("node_id", "cui").agg(F.min(F.struct(*CHOICE)).alias("place")).select("node_id", "cui", "place.*")


def numbered_lists(candidates: DataFrame, assigned: DataFrame | None = None) -> DataFrame:
    """``concept_rows`` with the place of each concept in its node's list, and the ``LIST_FACTS`` of the list.

    The candidates, which are written, tell whether a node can have too many concepts for one
    task. Where none can, the rows of a node meet in one shuffle, which serves the distinct
    concepts and their numbers; else ``number_within`` looks at the distinct ones.
    """
    order = [*CHOICE, "cui"]
    itself = F.coalesce(F.col("cui") == F.col("node_id"), F.lit(False))
    kept = ["node_id", "cui", "rank", F.col("place").alias("pos")]
    rows = candidates if assigned is None else _assigned_too(candidates, assigned)
    if hot_keys(candidates, ["node_id"]) is not None:
        numbered = cut_lineage(number_within(concept_rows(rows), "node_id", order, "place").select(*kept))
        facts = numbered.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_listed"), F.max(itself).alias("lists_itself"))
        return numbered.join(facts, ["node_id"], "left").select(*numbered.columns, *LIST_FACTS)
    window = Window.partitionBy("node_id")
    return concept_rows(rows.repartition("node_id")).select(
        "node_id", "cui", "rank", F.row_number().over(window.orderBy(*order)).cast("bigint").alias("pos"),
        F.count(F.lit(1)).over(window).alias("n_listed"), F.max(itself).over(window).alias("lists_itself"),
    )


def concept_positions(candidates: DataFrame, assigned: DataFrame | None = None) -> DataFrame:
    """``numbered_lists`` without the facts; the assigned concept is added where absent."""
    return numbered_lists(candidates, assigned).drop(*LIST_FACTS)


def _assigned_too(candidates: DataFrame, assigned: DataFrame) -> DataFrame:
    none = F.lit(0).cast("bigint")
    extra = assigned.select(
        "node_id", F.lit(ASSIGNED).alias("rank"), none.alias("xref_ord"), F.lit(0).alias("step"),
        none.alias("ord"), none.alias("pos"), F.col("assigned_cui").alias("cui"),
    )
    return candidates.unionByName(extra)


def with_assigned(listed: DataFrame, assigned: DataFrame) -> DataFrame:
    """The lists, and behind them the assigned concept of each node whose list has it not.

    A concept is taken from the node's list or is the node's own code, so the ``LIST_FACTS``
    that ``assigned`` brings along tell without a join which rows are to be added, and where.
    """
    own = assigned.where("assigned_cui = node_id AND NOT coalesce(lists_itself, false)").select(
        "node_id", F.col("assigned_cui").alias("cui"), (F.coalesce("n_listed", F.lit(0)) + 1).alias("pos")
    )
    # a null id meets no list row in a join, so its list is looked at by itself
    unnamed = listed.where("node_id IS NULL").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("cui").isNull()).alias("lists_null"))
    nameless = assigned.where("node_id IS NULL").select("node_id", F.col("assigned_cui").alias("cui")).crossJoin(unnamed)
    nameless = nameless.where("NOT coalesce(lists_null, false)").select("node_id", "cui", (F.col("n") + 1).alias("pos"))
    added = own.unionByName(nameless).select("node_id", "cui", F.lit(ASSIGNED).alias("rank"), "pos")
    return listed.select("node_id", "cui", "rank", "pos").unionByName(added)


def shared_members(resolved: DataFrame) -> DataFrame:
    """Which nodes share which first choice, one row per node."""
    return resolved.where("assignment_comment <> 'default'").select("first_cui", "node_id", "assigned_cui")


def assign_concepts(
    nodes: DataFrame, coderels: DataFrame, mode: str = "own_code", xrefs: DataFrame | None = None, concepts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(node_id, rank, first_cui, assigned_cui, assignment_comment) and the list rows.

    ``mode`` is ``own_code`` (a shared first choice goes to nobody) or ``greedy``. ``coderels``
    needs the columns codeid, start_id, step, ord and pos only; ``concepts`` (start_id) are its
    concepts, where they are at hand.
    """
    # three steps read the spelled-out cross-references; written once, they are spelled once
    xrefs = cut_lineage(xref_rows(nodes) if xrefs is None else xrefs)
    candidates = cut_lineage(candidate_concepts(nodes, xrefs, coderels, concepts))
    # the first rows of the numbered lists are the choice
    listed = cut_lineage(numbered_lists(candidates))
    choice = listed_choice(nodes, listed)
    if mode == "own_code":
        assigned = resolve_shared(choice)
    elif mode == "greedy":
        assigned = resolve_shared_greedy(choice, listed, nodes.select("node_id", "ord"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    assigned = cut_lineage(assigned)
    return assigned.drop(*LIST_FACTS), with_assigned(listed, assigned)
