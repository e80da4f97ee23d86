"""Relation names: one label per predicate, looked up in relation references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import after_last, pair_literal
from vocabweave.functions.fixed_values import OBO_PREFIX, RDF_TYPE, RDFS_TYPE, RELATION_LABELS
from vocabweave.operators.affixes import affix_join
from vocabweave.operators.keyed import first_per_key

REFERENCE_DOCUMENT = (
    "graphs array<struct<nodes:array<struct<id:string,lbl:string,meta:struct<definition:struct<val:string>>>>,"
    "edges:array<struct<sub:string,pred:string,obj:string>>>>"
)


def read_relation_reference(documents: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(id, lbl, def, ord) and (sub, pred, obj, ord) of relation documents, first graph of each."""
    graph = documents.select(F.get(F.from_json(F.col(text), REFERENCE_DOCUMENT)["graphs"], F.lit(0)).alias("g"))
    nodes = graph.select(F.posexplode("g.nodes").alias("ord", "n")).select(
        "n.id", "n.lbl", F.col("n.meta.definition.val").alias("def"), F.col("ord").cast("bigint").alias("ord")
    )
    edges = graph.select(F.posexplode("g.edges").alias("ord", "e")).select("e.*", F.col("ord").cast("bigint").alias("ord"))
    return nodes, edges


def format_relation(label: Column) -> Column:
    """Lower-case label of letters, digits and underscores that starts with no digit."""
    text = F.lower(F.translate(label, ".-()[]{}: ", "__________"))
    return F.when(text.rlike(r"^\p{N}"), F.concat(F.lit("rel_"), text)).otherwise(text)


def _reference_label(label: Column) -> Column:
    return after_last(F.replace(label, F.lit(" "), F.lit("_")), "/")


def relation_inverses(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(iri, label, inverse_label, ord) of every relation.

    A relation that only occurs as the object of ``inverseOf`` takes the subject as its
    inverse. Relations without either keep a null inverse.
    """
    known = first_per_key(nodes, ["id"], ["ord"])
    labels = known.select("id", "lbl")
    pairs = edges.where("pred = 'inverseOf'")
    forward = first_per_key(pairs.select(F.col("sub").alias("id"), F.col("obj").alias("other"), "ord"), ["id"], ["ord", "other"])
    backward = first_per_key(
        pairs.select(F.col("obj").alias("id"), F.col("sub").alias("other"), "ord").join(
            forward.select("id"), "id", "left_anti"
        ),
        ["id"],
        ["ord", "other"],
    )
    inverse = (
        forward.unionByName(backward)
        .join(labels.select(F.col("id").alias("other"), F.col("lbl").alias("inverse")), "other", "left")
        .select("id", "inverse")
    )
    return known.join(inverse, "id", "left").select(
        F.lower("id").alias("iri"),
        _reference_label(F.col("lbl")).alias("label"),
        _reference_label(F.col("inverse")).alias("inverse_label"),
        "ord",
    )


def label_of_suffix(label: Column, pairs: Sequence[tuple[str, str]] = RELATION_LABELS) -> Column:
    """Label of the first code in the map that ``label`` ends with, any case; else null."""
    codes = pair_literal([(code.strip().lower(), name.strip()) for code, name in pairs])
    text = F.lower(F.trim(label))
    return F.get(F.filter(codes, lambda pair: F.endswith(text, pair["key"])), F.lit(0))["value"]


def relation_names(
    predicates: DataFrame,
    reference: DataFrame,
    spatial: DataFrame | None = None,
    pairs: Sequence[tuple[str, str]] | DataFrame = RELATION_LABELS,
) -> DataFrame:
    """(predicate, relation_label, inverse_label) for distinct predicates.

    ``reference`` is the result of ``relation_inverses``; ``spatial`` has (id, lbl, ord).
    Precedence: reference by IRI, by ``RO:code``, by label; spatial reference by IRI; text
    after ``#``; text after the last ``/``. The lookups are joins on distinct keys. ``pairs`` is
    a short map, or a table (key, value, ord) of any size.
    """
    by_iri = first_per_key(reference.where("iri IS NOT NULL"), ["iri"], ["ord"])
    by_label = first_per_key(reference.where("label IS NOT NULL"), ["label"], ["ord"])

    def looked_up(tag: str, side: DataFrame, key: str) -> DataFrame:
        return side.select(
            F.col(key).alias(f"{tag}_key"), F.col("label").alias(f"{tag}_label"), F.col("inverse_label").alias(f"{tag}_inverse")
        )

    predicate = F.col("predicate")
    found = (
        predicates.select("predicate").distinct()
        .withColumn("iri_key", F.lower(predicate))
        .withColumn("code_key", F.concat(F.lit(OBO_PREFIX), F.replace(F.lower(predicate), F.lit(":"), F.lit("_"))))
        .withColumn("name_key", after_last(F.translate(predicate, " #", "_/"), "/"))
        .join(looked_up("iri", by_iri, "iri"), "iri_key", "left")
        .join(looked_up("code", by_iri, "iri"), "code_key", "left")
        .join(looked_up("name", by_label, "label"), "name_key", "left")
    )
    if spatial is not None:
        places = first_per_key(spatial.select(F.lower("id").alias("iri_key"), F.lower("lbl").alias("place_label"), "ord"), ["iri_key"], ["ord"])
        found = found.join(places.drop("ord"), "iri_key", "left")
    else:
        found = found.withColumn("place_label", F.lit(None).cast("string"))

    after_hash = F.when(predicate.contains("#"), after_last(predicate, "#"))
    looked = F.coalesce("iri_label", "code_label", "name_label", "place_label", after_hash, after_last(predicate, "/"))
    isa = predicate.isin(RDF_TYPE, RDFS_TYPE) | looked.contains("subClassOf")
    if isinstance(pairs, DataFrame):
        codes = pairs.select(F.lower(F.trim("key")).alias("key"), F.trim("value").alias("value"), "ord")
        found = affix_join(found.withColumn("looked_text", F.lower(F.trim(looked))), "looked_text", codes, "suffix_label")
        of_suffix = F.col("suffix_label")
    else:
        of_suffix = label_of_suffix(looked, pairs)
    label = F.when(isa, F.lit("isa")).otherwise(F.coalesce(of_suffix, looked))
    named = found.select(
        "predicate",
        label.alias("label"),
        F.coalesce("iri_inverse", "code_inverse", "name_inverse").alias("inverse"),
    )
    return named.select(
        "predicate",
        format_relation(F.col("label")).alias("relation_label"),
        format_relation(F.coalesce("inverse", F.concat(F.lit("inverse_"), F.col("label")))).alias("inverse_label"),
    )


def standardize_relations(
    edges: DataFrame,
    reference: DataFrame,
    spatial: DataFrame | None = None,
    pairs: Sequence[tuple[str, str]] | DataFrame = RELATION_LABELS,
) -> DataFrame:
    """Edges with the standard label in place of their predicate."""
    names = relation_names(edges, reference, spatial, pairs).select("predicate", "relation_label")
    joined = edges.join(names, ["predicate"], "left")
    return joined.withColumn("predicate", F.col("relation_label")).select(*edges.columns)
