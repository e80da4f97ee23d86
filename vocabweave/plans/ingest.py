"""Folding a source into the graph: new labels, concepts, terms, links and counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabweave.functions.text import custom_values, props_map, standardize_synonym, standardize_synonyms
from vocabweave.operators.chains import chain_ends
from vocabweave.operators.keyed import hashed_side
from vocabweave.operators.resolve import assign_concepts, complete_nodes, missing_nodes, shared_members
from vocabweave.session import cut_lineage
from vocabweave.sources.known import Known, add_known, known_rows, load_known, store_known
from vocabweave.sources.tables import (
    EDGE_COLUMNS,
    NODE_COLUMNS,
    Graph,
    load_graph,
    load_moves,
    load_steps,
    save_graph,
    step_folder,
    union_sources,
    write_text_table,
)

NODE_BASE = [*NODE_COLUMNS, "ord"]
EDGE_BASE = [*EDGE_COLUMNS, "ord"]


def source_exists(sources: DataFrame, sab: str) -> bool:
    return not sources.where(F.upper("sab") == sab.upper()).isEmpty()


def mark_known_sources(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """(sab, known) for several sources at once."""
    have = sources.select(F.upper("sab").alias("_key")).distinct().withColumn("_known", F.lit(True))
    joined = candidates.withColumn("_key", F.upper("sab")).join(have, "_key", "left")
    return joined.select("sab", F.coalesce("_known", F.lit(False)).alias("known"))


def new_rel_labels(edges: DataFrame, rel_labels: DataFrame, sab: str) -> DataFrame:
    """Predicates that are no relation label yet."""
    predicates = edges.groupBy("predicate").agg(F.min("ord").alias("ord"))
    known = rel_labels.select(F.col("rel_label").alias("predicate")).distinct()
    return predicates.join(known, "predicate", "left_anti").select(
        F.concat(F.lit(f"{sab.upper()}:"), F.col("predicate")).alias("id"),
        F.col("predicate").alias("rel_label"),
        F.col("predicate").alias("def"),
        F.lit(sab.upper()).alias("sab"),
        "ord",
    )


def new_concepts(nodes: DataFrame, concept_list: DataFrame, coderels: DataFrame, sab: str) -> DataFrame:
    """Concepts that no code links to yet, named by the first node that has them."""
    labels = nodes.select("node_id", "node_label", "ord")
    listed = concept_list.join(labels, ["node_id"])
    first = listed.groupBy("cui").agg(F.min(F.struct("ord", "pos", "node_id", "node_label")).alias("first"))
    known = coderels.select(F.col("start_id").alias("cui")).distinct()
    return first.join(known, "cui", "left_anti").select(
        F.array(F.lit("Concept")).alias("labels"),
        F.col("cui").alias("id"),
        F.col("first.node_label").alias("pref_term"),
        F.lit(sab.upper()).alias("sab"),
        F.col("first.ord").alias("ord"),
    )


def synonym_rows(nodes: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """(node_id, synonym, ord): the list cells as rows, and the rows (node_id, synonym) of ``synonyms``."""
    rows = nodes.select("node_id", F.explode("node_synonyms").alias("synonym"), "ord")
    if synonyms is not None:
        spelled = synonyms.select("node_id", standardize_synonym(F.col("synonym")).alias("synonym"))
        rows = rows.unionByName(spelled.join(nodes.select("node_id", "ord"), ["node_id"]))
    return rows.where("synonym <> ''")


def new_terms(nodes: DataFrame, terms: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Node labels, then synonyms that are no label, which are no term yet."""
    labels = nodes.groupBy(F.col("node_label").alias("id")).agg(F.min("ord").alias("ord"))
    others = (
        synonym_rows(nodes, synonyms)
        .groupBy(F.col("synonym").alias("id"))
        .agg(F.min("ord").alias("ord"))
        .join(labels, "id", "left_anti")
    )
    named = labels.withColumn("kind", F.lit(0)).unionByName(others.withColumn("kind", F.lit(1)))
    return named.join(terms.select("id").distinct(), "id", "left_anti")


def build_coderels(nodes: DataFrame, concept_list: DataFrame, sab: str, synonyms: DataFrame | None = None) -> DataFrame:
    """Links from each concept of a node to its label (PT) and its synonyms (SY).

    Nodes that are UMLS concepts themselves get none. All columns beyond the node columns
    travel along as properties. A node meets its concepts once, and its terms are spelled out
    behind that join; only ``synonyms`` that are rows are joined by themselves.
    """
    blank = F.lit("")
    carried, props = _carried(nodes, NODE_BASE)
    described = nodes.where(~F.col("node_id").startswith("UMLS:")).select(
        "node_id", "node_label", "node_definition", "node_synonyms", "ord", *carried,
    )
    listed = described.join(concept_list.select("node_id", "cui", "pos"), ["node_id"])

    def link(tty: Column, term: Column, definition: Column) -> Column:
        return F.struct(tty.alias("tty"), term.alias("term"), definition.alias("def"))

    own = F.array(link(F.lit("PT"), F.col("node_label"), F.col("node_definition")))
    cell = F.coalesce(F.filter("node_synonyms", lambda synonym: synonym != ""), F.array().cast("array<string>"))
    others = F.transform(cell, lambda synonym: link(F.lit("SY"), synonym, blank))
    linked = listed.withColumn("link", F.explode(F.concat(own, others)))
    if synonyms is not None:
        spelled = synonyms.select("node_id", standardize_synonym(F.col("synonym")).alias("synonym")).where("synonym <> ''")
        linked = linked.unionByName(spelled.join(listed, ["node_id"]).withColumn("link", link(F.lit("SY"), F.col("synonym"), blank)).drop("synonym"))
    return linked.select(
        F.col("cui").alias("start_id"),
        F.col("link.term").alias("end_id"),
        F.lit(sab).alias("sab"),
        F.col("link.def").alias("def"),
        F.col("node_id").alias("codeid"),
        F.col("link.tty").alias("tty"),
        props.alias("props"),
        "ord",
        "pos",
    )


def _carried(table: DataFrame, base: Sequence[str]) -> tuple[list[Column], Column]:
    """The columns outside ``base`` as text under free names, and the map that they make behind a join.

    A map is bulky in a shuffle, and a reader of one property needs no map at all.
    """
    values = custom_values(table, base)
    names = {name: f"_prop_{i}" for i, name in enumerate(values)}
    return [values[n].alias(free) for n, free in names.items()], props_map({n: F.col(free) for n, free in names.items()})


def edges_to_rels(edges: DataFrame, assigned: DataFrame, sab: str) -> DataFrame:
    """Edges between the assigned concepts of their ends, self-references included."""
    start = assigned.select(F.col("node_id").alias("subject"), F.col("assigned_cui").alias("start_id"))
    end = assigned.select(F.col("node_id").alias("object"), F.col("assigned_cui").alias("end_id"))
    carried, props = _carried(edges, EDGE_BASE)
    started = edges.select(*EDGE_COLUMNS, "ord", *carried).join(start, ["subject"])
    return started.join(end, ["object"]).select(
        F.col("predicate").alias("label"), "start_id", "end_id", F.lit(sab).alias("sab"), props.alias("props"), "ord"
    )


def split_self_edges(rels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links between two concepts, links of a concept to itself)."""
    return rels.where("start_id <> end_id"), rels.where("start_id = end_id")


def only_new(new: DataFrame, old: DataFrame) -> DataFrame:
    """New links whose (concept, code) pair the graph does not have."""
    return new.join(old.select("start_id", "codeid").distinct(), ["start_id", "codeid"], "left_anti")


KINDS = {
    "Source": "sources", "Node_Label": "node_labels", "Rel_Label": "rel_labels",
    "Concept": "concepts", "Term": "terms", "CODE rels": "coderels", "non-CODE rels": "rels",
}


def node_counts(before: Graph, after: Graph) -> DataFrame:
    """Rows per kind of object before and after an ingest."""
    def counted(kind: str, state: str, table: DataFrame) -> DataFrame:
        return table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("node_type"), F.lit(state).alias("state"), "n")

    counts = [counted(k, s, getattr(g, t)) for k, t in KINDS.items() for s, g in (("before", before), ("after", after))]
    return (
        union_sources(counts)
        .groupBy("node_type")
        .agg(
            F.max(F.when(F.col("state") == "before", F.col("n"))).alias("before"),
            F.max(F.when(F.col("state") == "after", F.col("n"))).alias("after"),
        )
    )


def grown_counts(before: Graph, added: Graph) -> DataFrame:
    """``node_counts`` of a graph to which rows are added only; each table is read once."""
    def counted(kind: str, table: str) -> DataFrame:
        rows = getattr(before, table).select(F.lit(1).alias("old")).union(getattr(added, table).select(F.lit(0)))
        return rows.agg(F.coalesce(F.sum("old"), F.lit(0)).alias("before"), F.count(F.lit(1)).alias("after")).select(
            F.lit(kind).alias("node_type"), "before", "after"
        )

    return union_sources([counted(kind, table) for kind, table in KINDS.items()])


def next_counts(previous: DataFrame, added: Graph) -> DataFrame:
    """``node_counts`` of a step, from those of the step before it and the rows that it adds."""
    new = union_sources([
        getattr(added, table).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("node_type"), "n") for kind, table in KINDS.items()
    ])
    return previous.select("node_type", F.col("after").alias("before")).join(new, ["node_type"]).select(
        "node_type", "before", (F.col("before") + F.col("n")).alias("after")
    )


@dataclass(frozen=True)
class Ingest:
    """The graph after an ingest and the tables that explain it."""

    graph: Graph
    #: The rows of ``graph`` that this source adds.
    added: Graph
    nodes: DataFrame
    assigned: DataFrame
    concept_list: DataFrame
    missing: DataFrame
    self_edges: DataFrame
    counts: DataFrame
    #: (old_cui, new_cui, codeid) of all codes that had concepts before, and the moves (old_cui, new_cui).
    changed: DataFrame
    moved: DataFrame

    def write_diagnostics(self, folder: str, mode: str = "error", counts: DataFrame | None = None) -> None:
        """Write the tables that explain the ingest; ``counts`` are its counts, where they are known from written tables."""
        write_text_table(self.missing, f"{folder}/missing_nodes", mode=mode)
        write_text_table(self.assigned, f"{folder}/node_concept_assignments", mode=mode)
        write_text_table(shared_members(self.assigned), f"{folder}/shared_concept_members", mode=mode)
        write_text_table(self.self_edges.drop("props"), f"{folder}/self_referential_edges", sep=",", mode=mode)
        write_text_table(self.counts if counts is None else counts, f"{folder}/node_counts", mode=mode)
        write_text_table(self.changed, f"{folder}/changed_concepts", sep=",", mode=mode)


def ingest_source(
    graph: Graph,
    edges: DataFrame,
    nodes: DataFrame,
    source: DataFrame,
    sab: str,
    step: int = 1,
    mode: str = "own_code",
    xrefs: DataFrame | None = None,
    own_sab_only: bool = False,
    only_new_links: bool = False,
    synonyms: DataFrame | None = None,
    move_concepts: bool = False,
    known: Known | None = None,
    write_links: bool = False,
) -> Ingest:
    """Fold one source into ``graph``; a source that is already in it is refused.

    ``nodes`` has array columns for synonyms and cross-references and an ``ord``. Where the
    values are rows already, they are given as ``synonyms`` (node_id, synonym), beside those in
    the column, and ``xrefs`` (node_id, xref_ord, xref), instead of the column; then the columns
    may be missing. ``own_sab_only`` uses only the cross-references of the source's own codes.

    With ``move_concepts``, concepts that earlier sources minted from a code of this source give
    way to those that it gives the code: links to them are rewritten in the whole graph, the rows
    keeping their step. A concept that is still assigned to a node stays.

    ``known`` are the codes, concepts and terms of ``graph`` as bucketed tables (``store_known``);
    then only the new source is shuffled to find out what is new.

    With ``write_links``, the links of codes and those between concepts are written as soon as
    they are known: who stores the graph and its diagnostics reads them several times.
    """
    known = known or known_rows(graph)
    if source_exists(graph.sources, sab):
        raise ValueError(f"source {sab} is already in the graph")
    nodes = nodes.withColumns({c: F.array(F.lit("")) for c in ("node_synonyms", "node_dbxrefs") if c not in nodes.columns})
    spelled = nodes.withColumn("node_synonyms", standardize_synonyms(F.col("node_synonyms")))
    whole = cut_lineage(complete_nodes(edges, spelled))
    if own_sab_only:
        own = F.col("node_id").startswith(f"{sab}:")
        if xrefs is not None:
            xrefs = xrefs.where(own)
        whole = whole.withColumn(
            "node_dbxrefs", F.when(own, F.col("node_dbxrefs")).otherwise(F.array(F.lit("")))
        )
    # the lists are read from the tables that the assignment has written
    assigned, concept_list = assign_concepts(whole, known.codes, mode, xrefs, known.concepts)

    links = build_coderels(whole, concept_list, sab, synonyms)
    if only_new_links:
        links = only_new(links, known.codes)
    every = edges_to_rels(edges, hashed_side(assigned), sab)
    if write_links:
        links, every = cut_lineage(links), cut_lineage(every)
    rels, self_edges = split_self_edges(every)
    new = {
        "sources": source,
        "rel_labels": new_rel_labels(edges, graph.rel_labels, sab),
        "concepts": new_concepts(whole, concept_list, known.concepts, sab),
        "terms": new_terms(whole, known.terms, synonyms),
        "coderels": links,
        "rels": rels,
    }

    def stepped(table: str, rows: DataFrame) -> DataFrame:
        if "ord" not in rows.columns:
            rows = rows.withColumn("ord", F.lit(0).cast("bigint"))
        return rows.withColumn("step", F.lit(step)).select(*getattr(graph, table).columns)

    added = Graph(**{
        table: stepped(table, new[table]) if table in new else old.limit(0) for table, old in graph.tables().items()
    })
    after = Graph(**{
        table: old.unionByName(getattr(added, table), allowMissingColumns=True) if table in new else old
        for table, old in graph.tables().items()
    })
    changed = changed_concepts(links, known.codes)
    if move_concepts:
        moved = cut_lineage(moved_concepts(changed, assigned))
        all_rels, all_links = rewrite_moved(after.rels, after.coderels, moved)
        after = replace(after, rels=all_rels, coderels=all_links, concepts=without_moved(after.concepts, moved))
        added = Graph(**{table: rows.where(F.col("step") == step) for table, rows in after.tables().items()})
        counts = node_counts(graph, after)
    else:
        moved = changed.select("old_cui", "new_cui").limit(0)
        counts = grown_counts(graph, added)
    return Ingest(after, added, whole, assigned, concept_list, missing_nodes(edges, nodes), self_edges, counts, changed, moved)


def build_context(
    spark: SparkSession,
    graph: Graph,
    sources: Sequence[tuple[str, Callable[[], tuple[DataFrame, DataFrame, DataFrame]]]],
    folder: str,
    mode: str = "own_code",
    move_concepts: bool = False,
    bucketed: bool = False,
) -> Graph:
    """Fold sources into the graph in the given order; later ones see earlier codes.

    A step writes only the rows it adds and the concepts it moves, with its diagnostics, to a
    folder of its own below ``folder``; its counts are written last and mark it as finished.
    Step 0 is the graph given. Rows of earlier steps are never written again: ``load_context``
    does the moves of later steps in them. A run on a folder that holds finished steps goes on
    after the last of them. With ``bucketed``, what the graph knows is kept below ``folder`` in
    bucketed tables, so that a step shuffles its own source only; moves would change these
    tables, so it is one or the other.
    """
    if bucketed and move_concepts:
        raise ValueError("moved concepts change what the graph knows: not with bucketed tables")
    def finished(step: int) -> bool:
        try:
            return not spark.read.parquet(f"{step_folder(folder, step)}/counts").isEmpty()
        except AnalysisException:
            return False

    def finish(step: int, counts: DataFrame) -> None:
        counts.write.mode("overwrite").parquet(f"{step_folder(folder, step)}/counts")

    if not finished(0):
        if bucketed:
            store_known(graph, f"{folder}/known")
        save_graph(graph, step_folder(folder, 0), "overwrite")
        start = load_graph(spark, step_folder(folder, 0))
        finish(0, node_counts(start, start))
    for step, (sab, load) in enumerate(sources, start=1):
        if finished(step):
            continue
        before = load_context(spark, folder, range(step))
        edges, nodes, source = load()
        result = ingest_source(before, edges, nodes, source, sab, step, mode, move_concepts=move_concepts, known=load_known(spark, f"{folder}/known") if bucketed else None, write_links=True)
        save_graph(result.added, step_folder(folder, step), "overwrite")
        # counted where they lie: their files say how many rows they have
        added = load_graph(spark, step_folder(folder, step))
        if bucketed:
            add_known(added, f"{folder}/known")
        if move_concepts:
            result.moved.write.mode("overwrite").parquet(f"{step_folder(folder, step)}/moved")
        if result.moved.isEmpty():
            counts = next_counts(spark.read.parquet(f"{step_folder(folder, step - 1)}/counts"), added)
        else:
            counts = node_counts(before, load_context(spark, folder, range(step + 1)))
        result.write_diagnostics(f"{step_folder(folder, step)}/diagnostics", "overwrite", counts)
        finish(step, counts)
    return load_context(spark, folder, range(len(sources) + 1))


# ---- concepts that change when a code's own source arrives later -------------------------


def changed_concepts(new_coderels: DataFrame, old_coderels: DataFrame) -> DataFrame:
    """Old and new concepts of every code that both sets of links know."""
    new = new_coderels.select("codeid", F.col("start_id").alias("new_cui")).distinct()
    old = old_coderels.select("codeid", F.col("start_id").alias("old_cui")).distinct()
    return new.join(old, ["codeid"]).select("old_cui", "new_cui", "codeid")


def moved_concepts(changes: DataFrame, in_use: DataFrame | None = None) -> DataFrame:
    """(old_cui, new_cui): the concepts minted from a code that give way, and where they end up.

    A concept that an ``in_use`` row (assigned_cui) still names stays. A concept that gives way to
    one that gives way itself goes on to the end of the chain; of concepts that only give way to
    each other the smallest stays.
    """
    minted = changes.where("old_cui = codeid AND new_cui <> old_cui").select("old_cui", "new_cui").distinct()
    if in_use is not None:
        minted = minted.join(in_use.select(F.col("assigned_cui").alias("old_cui")).distinct(), ["old_cui"], "left_anti")
    return chain_ends(minted, "old_cui", "new_cui").where("old_cui <> new_cui")


def rewrite_changed(
    rels: DataFrame, coderels: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Links and code links after minted concepts gave way to the new ones.

    Only concepts minted from the code itself are replaced. A link whose ends both changed
    is rewritten for each pair of new concepts. The code's own link to its old concept goes;
    links of other codes to it move along.
    """
    return rewrite_moved(rels, coderels, moved_concepts(changes))


def rewrite_moved(rels: DataFrame, coderels: DataFrame, moved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rels`` and ``coderels`` after the moves (old_cui, new_cui).

    Moves with the columns ``since`` and ``step`` concern the rows of the steps from ``since``
    and before ``step`` only.
    """
    def rewritten(links: DataFrame, end: str) -> DataFrame:
        here = moved.select(*[F.col(c).alias(f"_{c}") for c in moved.columns])
        met = links[end] == here["_old_cui"]
        if "_since" in here.columns:
            met = met & (links["step"] >= here["_since"]) & (links["step"] < here["_step"])
        joined = links.join(here, met, "left")
        columns = [F.coalesce("_new_cui", links[end]).alias(end) if c == end else links[c] for c in links.columns]
        return joined.select(*columns, F.col("_new_cui").isNotNull().alias("_moved"))

    links = rels.select("*")
    for end in ("end_id", "start_id"):
        links = rewritten(links, end).drop("_moved")
    # the concept that was minted from a code is no longer one of the code's own
    codes = rewritten(coderels.withColumn("_own", F.col("start_id") == F.col("codeid")), "start_id")
    return links, codes.where("NOT (_moved AND _own)").select(*coderels.columns)


def without_moved(concepts: DataFrame, moved: DataFrame) -> DataFrame:
    """``concepts`` without those that have moved (in the steps that the moves concern)."""
    here = moved.select(*[F.col(c).alias(f"_{c}") for c in moved.columns]).drop("_new_cui").distinct()
    met = concepts["id"] == here["_old_cui"]
    if "_since" in here.columns:
        met = met & (concepts["step"] >= here["_since"]) & (concepts["step"] < here["_step"])
    return concepts.join(here, met, "left_anti")


def moves_by_step(moves: DataFrame) -> DataFrame:
    """Where the rows of earlier steps end up, from the moves (step, old_cui, new_cui) of all steps.

    A row of a step follows the first later move of its concept, then the first move after that
    one of the new concept, and so on. A concept can be minted again after it moved: each of its
    moves concerns the steps ``since`` its last one and before ``step``.
    """
    times = moves.select("old_cui", "step").distinct()
    earlier = Window.partitionBy("old_cui").orderBy("step")
    spans = times.withColumn("since", F.coalesce(F.lag("step").over(earlier), F.lit(0)))
    # the move that a move leads to: the first later one of its new concept
    later = times.select(F.col("old_cui").alias("_next"), F.col("step").alias("_at"))
    leads = moves.join(later, (F.col("new_cui") == F.col("_next")) & (F.col("_at") > F.col("step")), "left")
    leads = leads.groupBy("step", "old_cui", "new_cui").agg(F.min("_at").alias("_at"))
    # a move is named by its concept and step; what never moves again has no step
    named = leads.select(F.struct("old_cui", "step").alias("move"), F.struct(F.col("new_cui").alias("old_cui"), F.col("_at").alias("step")).alias("to"))
    ends = chain_ends(named, "move", "to").select("move.*", F.col("to.old_cui").alias("new_cui"))
    return ends.join(spans, ["old_cui", "step"]).select("old_cui", "new_cui", "since", "step")


def load_context(spark: SparkSession, folder: str, steps: Sequence[int]) -> Graph:
    """Graph of the given steps of a context, with the moves of later steps done in the rows of earlier ones."""
    graph = load_steps(spark, folder, steps)
    moves = load_moves(spark, folder, steps)
    if moves is None or moves.isEmpty():
        return graph
    moves = cut_lineage(moves_by_step(moves))
    rels, coderels = rewrite_moved(graph.rels, graph.coderels, moves)
    return replace(graph, rels=rels, coderels=coderels, concepts=without_moved(graph.concepts, moves))
