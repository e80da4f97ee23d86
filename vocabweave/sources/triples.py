"""Triple tables (s, p, o) of an ontology to edges and nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import iri_namespace, standardize_code
from vocabweave.functions.fixed_values import (
    OBO_DBXREF, OBO_DEFINITION, OBO_SYNONYM, OWL_AXIOM, OWL_CLASS, OWL_DISJOINT, OWL_EQUIVALENT, OWL_FILLERS,
    OWL_INTERSECTION, OWL_ON_PROPERTY, OWL_PROPERTY, OWL_SOURCE, OWL_TARGET, OWL_UNION, RDF_FIRST, RDF_NIL, RDF_REST,
    RDF_TYPE, RDFS_LABEL, RDFS_SUBCLASS,
)
from vocabweave.functions.text import default_label
from vocabweave.operators.chains import chain_ends
from vocabweave.operators.keyed import list_rows
from vocabweave.operators.relations import standardize_relations
from vocabweave.session import cut_lineage
from vocabweave.sources.tables import union_sources


def ontology_classes(triples: DataFrame) -> DataFrame:
    return triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == OWL_CLASS)).select("s").distinct()


def class_metadata(triples: DataFrame) -> DataFrame:
    """(node_id, label, definition, namespace), one row per class; ``None`` stands for a missing value."""
    classes = ontology_classes(triples)
    described = triples.where(F.col("p").isin(RDFS_LABEL, OBO_DEFINITION)).groupBy("s").agg(
        F.min(F.when(F.col("p") == RDFS_LABEL, F.col("o"))).alias("label"),
        F.min(F.when(F.col("p") == OBO_DEFINITION, F.col("o"))).alias("definition"),
    )
    return classes.join(described, "s", "left").select(
        F.col("s").alias("node_id"),
        *[F.coalesce(F.col(c), F.lit("None")).alias(c) for c in ("label", "definition")],
        iri_namespace(F.col("s")).alias("namespace"),
    )


def class_values(triples: DataFrame) -> DataFrame:
    """(node_id, kind, pos, value): each synonym and cross-reference of a class in a row of its own, in order."""
    kind = F.when(F.col("p") == OBO_SYNONYM, "synonym").otherwise("dbxref")
    values = triples.where(F.col("p").isin(OBO_SYNONYM, OBO_DBXREF)).select("s", kind.alias("kind"), F.col("o").alias("value")).distinct()
    own = values.join(ontology_classes(triples), ["s"], "left_semi").withColumn("list", F.struct("s", "kind"))
    return list_rows(own, "list", "value", ["value"]).select(F.col("list.s").alias("node_id"), "list.kind", "pos", "value")


def kept_entities(triples: DataFrame) -> DataFrame:
    """(entity, kind): classes, and axioms whose source and target are classes.

    One end may also be an entity without any type.
    """
    types = triples.where(F.col("p") == RDF_TYPE).groupBy(F.col("s").alias("o")).agg(
        F.max((F.col("o") == OWL_CLASS)).alias("is_class")
    )
    axioms = triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == OWL_AXIOM)).select("s").distinct()
    ends = triples.where(F.col("p").isin(OWL_SOURCE, OWL_TARGET))
    ends = ends.join(axioms, ["s"], "left_semi")
    typed = ends.join(types, ["o"], "left")
    state = typed.groupBy("s").agg(
        F.max(F.coalesce("is_class", F.lit(False))).alias("any_class"),
        F.max(F.col("is_class").isNotNull() & ~F.col("is_class")).alias("any_other"),
        F.count_if(F.col("p") == OWL_SOURCE).alias("n_source"),
        F.count_if(F.col("p") == OWL_TARGET).alias("n_target"),
    )
    good = state.where("any_class AND NOT any_other AND n_source > 0 AND n_target > 0")
    return ontology_classes(triples).select(F.col("s").alias("entity"), F.lit("class").alias("kind")).unionByName(
        good.select(F.col("s").alias("entity"), F.lit("axiom").alias("kind"))
    )


def class_links(triples: DataFrame) -> DataFrame:
    """Triples between two classes, without types and disjointness."""
    classes = ontology_classes(triples)
    links = triples.where(~F.col("p").isin(RDF_TYPE, OWL_DISJOINT)).select("s", "p", "o").distinct()
    started = links.join(classes, ["s"], "left_semi")
    return started.join(classes.withColumnRenamed("s", "o"), ["o"], "left_semi")


def _pairs(triples: DataFrame, predicates: str | list[str], s: str, o: str) -> DataFrame:
    """The distinct subjects and objects of some predicates, under these names."""
    wanted = [predicates] if isinstance(predicates, str) else predicates
    return triples.where(F.col("p").isin(wanted)).select(F.col("s").alias(s), F.col("o").alias(o)).distinct()


def stated_links(triples: DataFrame) -> DataFrame:
    """(s, p, o) of the statements that kept axioms are about: their source, property and target.

    Both ends have to be IRIs, so that a statement on a text gives no link.
    """
    axioms = kept_entities(triples).where("kind = 'axiom'").select(F.col("entity").alias("axiom"))
    links = (
        _pairs(triples, OWL_SOURCE, "axiom", "s").join(axioms, "axiom", "left_semi")
        .join(_pairs(triples, OWL_PROPERTY, "axiom", "p"), "axiom")
        .join(_pairs(triples, OWL_TARGET, "axiom", "o"), "axiom")
    )
    named = lambda end: F.col(end).rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    return links.where(named("s") & named("o") & ~F.col("p").isin(RDF_TYPE, OWL_DISJOINT)).select("s", "p", "o").distinct()


def list_members(triples: DataFrame) -> DataFrame:
    """(head, member) of all lists, of any length: every cell finds its head by pointer doubling."""
    cells = _pairs(triples, RDF_FIRST, "cell", "member")
    before = _pairs(triples, RDF_REST, "before", "cell").where(F.col("cell") != RDF_NIL)
    heads = chain_ends(before, "cell", "before").select("cell", F.col("before").alias("head"))
    return cells.join(heads, "cell", "left").select(F.coalesce("head", "cell").alias("head"), "member").distinct()


def decoded_links(triples: DataFrame) -> DataFrame:
    """(s, p, o) between classes that blank nodes spell out: restrictions, intersections and unions.

    A class below (or equal to) a restriction on a property has that property to the filler. A class
    below an intersection is below its members, restrictions among them included, however deep
    intersections are nested; an intersection as filler stands for its members. The members of a union
    that a class equals are below that class.
    """
    classes = ontology_classes(triples)
    members = cut_lineage(list_members(triples))
    below = _pairs(triples, [RDFS_SUBCLASS, OWL_EQUIVALENT], "s", "expression").join(classes, ["s"], "left_semi")

    def parts(predicate: str) -> DataFrame:
        heads = _pairs(triples, predicate, "expression", "head")
        return heads.join(members, "head").select("expression", F.col("member").alias("part")).distinct()

    # every part of an intersection, nested ones too, with the outermost expression that holds it
    direct = cut_lineage(parts(OWL_INTERSECTION))
    inner = direct.join(direct.select(F.col("expression").alias("part")).distinct(), ["part"], "left_semi")
    outer = chain_ends(inner, "part", "expression").select(F.col("part").alias("expression"), F.col("expression").alias("outer"))
    held = direct.join(outer, "expression", "left").select(F.coalesce("outer", "expression").alias("expression"), "part")
    held = cut_lineage(held.unionByName(direct).distinct())

    reached = cut_lineage(below.unionByName(below.join(held, "expression").select("s", F.col("part").alias("expression"))).distinct())
    isa = below.join(held, "expression").select("s", F.lit(RDFS_SUBCLASS).alias("p"), F.col("part").alias("o"))
    fillers = _pairs(triples, OWL_FILLERS, "restriction", "filler")
    within = fillers.join(held.select(F.col("expression").alias("filler"), "part"), "filler").select("restriction", F.col("part").alias("filler"))
    restricted = (
        reached.select("s", F.col("expression").alias("restriction"))
        .join(_pairs(triples, OWL_ON_PROPERTY, "restriction", "p"), "restriction")
        .join(fillers.unionByName(within), "restriction")
        .select("s", "p", F.col("filler").alias("o"))
    )
    equal = _pairs(triples, OWL_EQUIVALENT, "o", "expression").join(parts(OWL_UNION), "expression")
    unions = equal.select(F.col("part").alias("s"), F.lit(RDFS_SUBCLASS).alias("p"), "o")
    links = isa.unionByName(restricted).unionByName(unions).distinct()
    return links.join(classes, ["s"], "left_semi").join(classes.withColumnRenamed("s", "o"), ["o"], "left_semi").select("s", "p", "o")


def logical_links(triples: DataFrame) -> DataFrame:
    """All links of an ontology: between classes, of kept axioms, and those that blank nodes spell out."""
    plain = class_links(triples).select("s", "p", "o")
    return plain.unionByName(stated_links(triples)).unionByName(decoded_links(triples)).distinct()


def triple_edges(triples: DataFrame, sab: str, reference: DataFrame, spatial: DataFrame | None = None) -> DataFrame:
    edges = logical_links(triples).select(
        standardize_code(F.col("s"), sab).alias("subject"), F.col("p").alias("predicate"),
        standardize_code(F.col("o"), sab).alias("object"),
    )
    return standardize_relations(edges, reference, spatial)


def nodes_in_links(metadata: DataFrame, links: DataFrame) -> DataFrame:
    """Class metadata of the classes that some link uses."""
    used = links.select(F.col("s").alias("node_id")).union(links.select("o")).distinct()
    return metadata.join(used, "node_id", "left_semi")


def triple_nodes(triples: DataFrame, sab: str) -> DataFrame:
    """Node table of the linked classes, without lists; the code stands in for a missing label."""
    missing = lambda name: F.nullif(F.col(name), F.lit("None"))
    node_id = standardize_code(F.col("node_id"), sab)
    return nodes_in_links(class_metadata(triples), logical_links(triples)).select(
        node_id.alias("node_id"),
        default_label(missing("label"), node_id).alias("node_label"),
        missing("definition").alias("node_definition"),
    )


def triple_node_values(triples: DataFrame, sab: str) -> DataFrame:
    """(node_id, kind, pos, value): synonyms and cross-references of the linked classes."""
    found = nodes_in_links(class_values(triples), logical_links(triples))
    return found.withColumn("node_id", standardize_code(F.col("node_id"), sab))


def triple_stats(triples: DataFrame) -> DataFrame:
    """(metric, n): distinct nodes, triples and distinct predicates."""
    nodes = triples.select("s").union(triples.select("o")).distinct()
    counts = {"nodes": nodes, "triples": triples, "predicates": triples.select("p").distinct()}
    return union_sources([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n") for name, df in counts.items()])


def non_null_report(nodes: DataFrame) -> DataFrame:
    """Rows, and rows whose synonyms, cross-references or both are not ``None``."""
    has = lambda name: ~F.col(name).contains("None")
    return nodes.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has("node_synonyms")).alias("n_synonyms"),
        F.count_if(has("node_dbxrefs")).alias("n_dbxrefs"),
        F.count_if(has("node_synonyms") & has("node_dbxrefs")).alias("n_both"),
    )
