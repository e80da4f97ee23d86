"""Class tables, term sheets, template maps and definition lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import after_last, standardize_code, text_id
from vocabweave.functions.fixed_values import DEFAULT_TEMPLATE_ENTITIES, OBO_DBXREF, TEMPLATE_PARENT
from vocabweave.functions.text import blank_if_null_like, first_column, strip_marker
from vocabweave.operators.keyed import first_per_key
from vocabweave.operators.relations import standardize_relations
from vocabweave.sources.tables import EDGE_COLUMNS

# ---- class tables ------------------------------------------------------------------------


def class_table_edges(classes: DataFrame, sab: str, component_label: str = "has_component") -> DataFrame:
    """``isa`` edges to the listed parents and one component edge per class."""
    subject = standardize_code(F.col("`Class ID`"), sab)

    def edges(column: str, predicate: str, items) -> DataFrame:
        filled = classes.where((F.col(column) != "nan") & F.col(column).isNotNull())
        rows = filled.select(subject.alias("subject"), F.explode(items).alias("raw")).where("raw <> ''")
        return rows.select("subject", F.lit(predicate).alias("predicate"), standardize_code(F.col("raw"), sab).alias("object"))

    found = edges("Parents", "isa", F.split("Parents", r"\|"))
    if "has_component" in classes.columns:
        found = found.unionByName(edges("has_component", component_label, F.array("has_component")))
    return found


def class_table_nodes(classes: DataFrame, sab: str) -> DataFrame:
    """Nodes whose definition, synonyms and cross-references come from whichever column exists."""
    return classes.select(
        standardize_code(F.col("`Class ID`"), sab).alias("node_id"),
        F.col("`Preferred Label`").alias("node_label"),
        first_column(classes, ["definition", "Definitions"]).alias("node_definition"),
        first_column(classes, ["has_exact_synonym", "Synonyms"]).alias("node_synonyms"),
        first_column(classes, ["database_cross_reference", OBO_DBXREF]).alias("node_dbxrefs"),
    )


# ---- term sheets -------------------------------------------------------------------------

TERM_SHEET_BASE = ["term", "code", "definition", "synonyms", "dbxrefs", "ord"]


def _listed_terms(column: str, predicate: str) -> Column:
    """(predicate, term) of each comma-separated term of a cell; none for a blank cell."""
    filled = F.filter(F.array(f"`{column}`"), lambda cell: cell != "")
    return F.transform(
        F.flatten(F.transform(filled, lambda cell: F.split(cell, ","))),
        lambda term: F.struct(F.lit(predicate).alias("predicate"), term.alias("term")),
    )


def unpivot_relations(sheet: DataFrame) -> DataFrame:
    """(subject, predicate, term): one row per term listed in a relation column.

    The first relation column is ``isa`` whatever its header says.
    """
    columns = [c for c in sheet.columns if c not in TERM_SHEET_BASE]
    cells = [_listed_terms(c, "isa" if i == 0 else c) for i, c in enumerate(columns)]
    rows = sheet.select(F.col("code").alias("subject"), F.explode(F.flatten(F.array(*cells))).alias("r"))
    return rows.select("subject", "r.predicate", "r.term")


def term_codes(rows: DataFrame, sheet: DataFrame) -> DataFrame:
    """``rows`` with ``object``, the code of their term; an undefined term stops the job."""
    codes = first_per_key(sheet.select("term", F.col("code").alias("object"), "ord"), ["term"], ["ord"])
    coded = rows.join(codes.drop("ord"), ["term"], "left")
    message = F.concat(F.lit("undefined term "), F.col("term"), F.lit(" in relations of "), F.col("subject"))
    return coded.withColumn("object", F.when(F.col("object").isNull(), F.raise_error(message)).otherwise(F.col("object")))


def term_sheet_edges(sheet: DataFrame, sab: str, reference: DataFrame, spatial: DataFrame | None = None) -> DataFrame:
    edges = term_codes(unpivot_relations(sheet), sheet).select(
        standardize_code(F.col("subject"), sab).alias("subject"), "predicate",
        standardize_code(F.col("object"), sab).alias("object"),
    )
    return standardize_relations(edges, reference, spatial)


def term_sheet_nodes(sheet: DataFrame) -> DataFrame:
    return sheet.select(
        F.col("code").alias("node_id"), strip_marker(F.col("term")).alias("node_label"),
        F.col("definition").alias("node_definition"),
        blank_if_null_like(F.col("synonyms")).alias("node_synonyms"),
        blank_if_null_like(F.col("dbxrefs")).alias("node_dbxrefs"),
    )


# ---- templates ---------------------------------------------------------------------------


def template_entity_map(
    edges: DataFrame, entities: DataFrame, columns: Sequence[str], parent: str = TEMPLATE_PARENT,
    default: Sequence[str] = DEFAULT_TEMPLATE_ENTITIES,
) -> DataFrame:
    """Edges from each child of the template parent to its entities.

    ``entities`` has (id, entity columns, ord); a template it does not name gets all
    defaults, a named one only its filled cells.
    """
    templates = edges.where(F.col("object") == parent).select(
        F.concat(F.lit("CEDAR:"), after_last(F.col("subject"), "/")).alias("subject")
    )
    named = first_per_key(entities, ["id"], ["ord"]).select(F.col("id").alias("subject"), F.array(*columns).alias("named"))
    joined = templates.join(named, ["subject"], "left")
    targets = F.coalesce(F.col("named"), F.array(*map(F.lit, default)))
    return joined.select("subject", F.lit("used_in_entity").alias("predicate"), F.explode(targets).alias("object")).where(
        "coalesce(object, '') <> ''"
    )


# ---- definitions -------------------------------------------------------------------------


def definition_rows(summaries: DataFrame, sab: str = "REFSEQ") -> DataFrame:
    """Distinct non-blank definitions of (uid, summary) rows with their code and the digest of their text id.

    The text id is longer than the text, so rows are told apart and joined by its digest and
    the id is spelled only in what comes out.
    """
    return (
        summaries.where("coalesce(summary, '') <> ''")
        .select(
            F.sha2(text_id(F.col("summary")), 256).alias("digest"), F.lit(sab).alias("sab"), F.col("summary").alias("def"),
            F.concat(F.lit("ENTREZ:"), F.col("uid").cast("string")).alias("code"),
        )
        .dropDuplicates(["digest", "code"])
    )


def _digests(table: DataFrame) -> DataFrame:
    return table.select(F.sha2("atui", 256).alias("digest")).distinct()


def new_definitions(found: DataFrame, definitions: DataFrame) -> DataFrame:
    """(atui, sab, def) of definitions whose id the table ``definitions`` (atui, ...) does not have."""
    new = found.join(_digests(definitions), ["digest"], "left_anti").dropDuplicates(["digest", "sab"])
    return new.select(text_id(F.col("def")).alias("atui"), "sab", "def")


def new_definition_links(found: DataFrame, links: DataFrame, concept_codes: DataFrame) -> DataFrame:
    """(atui, cui) of found definitions whose code has a concept and whose id has no link yet."""
    pairs = found.select("digest", "code").distinct().join(_digests(links), ["digest"], "left_anti")
    linked = pairs.join(concept_codes.select("code", "cui").distinct(), ["code"]).select("digest", "cui").distinct()
    texts = found.dropDuplicates(["digest"]).select("digest", text_id(F.col("def")).alias("atui"))
    return linked.join(texts, ["digest"]).select("atui", "cui")


def append_table(new: DataFrame, path: str) -> None:
    new.write.mode("append").parquet(path)


# ---- legacy pairs ------------------------------------------------------------------------


def restandardize(
    edges: DataFrame, nodes: DataFrame, sab: str, reference: DataFrame, spatial: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Edge and node tables with standard codes and relations, without the namespace column."""
    coded = edges.withColumn("subject", standardize_code(F.col("subject"), sab)).withColumn(
        "object", standardize_code(F.col("object"), sab)
    )
    named = standardize_relations(coded, reference, spatial)
    spelled = nodes.withColumn("node_id", standardize_code(F.col("node_id"), sab)).drop("node_namespace")
    return named.select(*EDGE_COLUMNS, *[c for c in edges.columns if c not in EDGE_COLUMNS]), spelled
