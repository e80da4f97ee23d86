"""Field vocabularies (field -> description, type, entities, assays, schemas) to edges and nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import after_last, numbered_id, rooms
from vocabweave.functions.fixed_values import FIELD_TYPE_XREFS
from vocabweave.functions.text import list_or_scalar
from vocabweave.operators.graph_queries import codes_of_concept, codes_of_term, path_expand
from vocabweave.operators.keyed import dense_number
from vocabweave.sources.tables import union_sources

# Ids of the parent nodes, by kind; the nodes of a kind follow its parent.
PARENT_IDS = {"sab": 0, "field": 1000, "type": 2000, "entity": 3000, "assay": 4000, "schema": 5000}
# Relation from a field to each kind.
FIELD_RELATIONS = {"type": "has_datatype", "entity": "used_in_entity", "assay": "used_in_dataset", "schema": "used_in_schema"}
# Sources of the cross-references of each kind.
XREF_SOURCES = {"field": "CEDAR", "entity": "HUBMAP", "assay": "HUBMAP"}


def padded_id(number: Column, sab: str) -> Column:
    """``SAB:`` and the number with at least four digits."""
    digits = number.cast("string")
    return F.concat(F.lit(f"{sab}:"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def field_values(table: DataFrame) -> DataFrame:
    """(field, value, ord, pos): one row per value of a field, scalar or list."""
    return table.select("field", "ord", F.posexplode(list_or_scalar(F.col("value"))).alias("pos", "value"))


def encode_values(table: DataFrame, kind: str, sab: str, parents: dict[str, int] = PARENT_IDS) -> DataFrame:
    """(label, definition, node_id): distinct values numbered by first occurrence.

    It is an error if a kind has more values than there are numbers before the next parent.
    """
    if kind == "field":
        firsts = table.groupBy(F.col("field").alias("label")).agg(
            F.min(F.struct("ord", F.lit(0).alias("pos"), F.col("value").alias("definition"))).alias("f")
        )
    else:
        rows = field_values(table)
        firsts = rows.groupBy(F.col("value").alias("label")).agg(F.min(F.struct("ord", "pos")).alias("f"))
    text = F.col("f.definition") if kind == "field" else F.concat(F.lit(f"{sab} "), F.col("label"), F.lit(f" {kind}"))
    flat = firsts.select("label", text.alias("definition"), F.col("f.ord").alias("ord"), F.col("f.pos").alias("pos"))
    numbered = dense_number(flat, ["ord", "pos", "label"], "n")
    return numbered.select("label", "definition", padded_id(numbered_id(parents[kind], F.col("n"), rooms(list(parents.values()))[parents[kind]]), sab).alias("node_id"))


def term_xref(labels: DataFrame, coderels: DataFrame, sab: str, spelled: Column) -> DataFrame:
    """``labels`` with ``node_dbxrefs``: smallest PT code of ``sab`` for the spelled label, else blank."""
    terms = labels.withColumn("term", spelled)
    codes = codes_of_term(coderels, terms, sab).groupBy("term").agg(F.min("codeid").alias("code"))
    return terms.join(codes, ["term"], "left").withColumn(
        "node_dbxrefs", F.coalesce("code", F.lit(""))
    ).drop("term", "code")


def datatype_codes(rels: DataFrame, coderels: DataFrame, root: str = "XSD:anySimpleType") -> DataFrame:
    """(type, code): XSD codes of the concepts up to two ``isa`` hops below the root."""
    start = rels.sparkSession.createDataFrame([(root,)], "cui string")
    below = path_expand(rels, start, ["isa"], "CEDAR", 1, 2, reverse=True).select("cui")
    codes = codes_of_concept(coderels, below, "XSD")
    return codes.groupBy(after_last(F.col("codeid"), ":").alias("type")).agg(F.min("codeid").alias("code"))


def type_xref(labels: DataFrame, types: DataFrame) -> DataFrame:
    """``labels`` with the datatype code of their label; two names have codes of their own."""
    special = F.coalesce(*[F.when(F.col("label") == name, F.lit(code)) for name, code in FIELD_TYPE_XREFS])
    joined = labels.join(types.withColumnRenamed("type", "label"), ["label"], "left")
    return joined.withColumn("node_dbxrefs", F.coalesce(special, F.col("code"), F.lit(""))).drop("code")


def association_edges(table: DataFrame, fields: DataFrame, objects: DataFrame, predicate: str) -> DataFrame:
    """Edges from the node of each field to the nodes of its values."""
    rows = field_values(table).select("field", "value")
    subjects = fields.select(F.col("label").alias("field"), F.col("node_id").alias("subject"))
    targets = objects.select(F.col("label").alias("value"), F.col("node_id").alias("object"))
    named = rows.join(subjects, ["field"])
    return named.join(targets, ["value"]).select(
        "subject", F.lit(predicate).alias("predicate"), "object"
    )


def vocabulary(
    tables: dict[str, DataFrame], sab: str, rels: DataFrame, coderels: DataFrame, assays: DataFrame,
    parents: dict[str, int] = PARENT_IDS,
) -> tuple[DataFrame, DataFrame]:
    """Edges and nodes of the five tables (field, value, ord), by kind.

    ``assays`` lists the assay terms (term) whose codes assay values may refer to; ``parents``
    gives the number of each kind's parent node.
    """
    encoded = {kind: encode_values(tables[kind], kind, sab, parents) for kind in parents if kind != "sab"}
    label = F.col("label")
    capital = F.concat(F.upper(F.substring(label, 1, 1)), F.lower(label.substr(F.lit(2), F.length(label))))
    known_assays = encoded["assay"].join(assays.select(F.col("term").alias("label")).distinct(), "label", "left_semi")
    other_assays = encoded["assay"].join(assays.select(F.col("term").alias("label")).distinct(), "label", "left_anti")
    with_xrefs = [
        term_xref(encoded["field"], coderels, XREF_SOURCES["field"], label),
        type_xref(encoded["type"], datatype_codes(rels, coderels)),
        term_xref(encoded["entity"], coderels, XREF_SOURCES["entity"], capital),
        term_xref(known_assays, coderels, XREF_SOURCES["assay"], label),
        other_assays.withColumn("node_dbxrefs", F.lit("")),
        encoded["schema"].withColumn("node_dbxrefs", F.lit("")),
    ]
    spark = rels.sparkSession
    parent_nodes = spark.createDataFrame(
        [(f"{sab}:{number:04d}", f"{sab} {kind} parent node", "", "") for kind, number in parents.items()],
        "node_id string, label string, definition string, node_dbxrefs string",
    )
    nodes = union_sources([parent_nodes, *with_xrefs]).select(
        "node_id", F.col("label").alias("node_label"), F.col("definition").alias("node_definition"),
        F.lit("").alias("node_synonyms"), "node_dbxrefs",
    )
    isa = [
        rows.select(F.col("node_id").alias("subject"), F.lit("isa").alias("predicate"), F.lit(f"{sab}:{parents[kind]:04d}").alias("object"))
        for kind, rows in encoded.items()
    ]
    associations = [
        association_edges(tables[kind], encoded["field"], encoded[kind], predicate) for kind, predicate in FIELD_RELATIONS.items()
    ]
    return union_sources([*isa, *associations]), nodes
