"""Protein tables to edges and nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.text import bracket_ids, first_word, outer_groups, recommended_name
from vocabweave.operators.keyed import first_per_key

# Annotation column -> default relation of its aspect.
ASPECTS = [
    ("Gene Ontology (biological process)", "involved_in"),
    ("Gene Ontology (cellular component)", "part_of"),
    ("Gene Ontology (molecular function)", "enables"),
]


def _protein_id():
    return F.concat(F.lit("UNIPROTKB:"), F.col("Entry"))


def symbol_lookup(proteins: DataFrame, symbols: DataFrame) -> DataFrame:
    """(subject, object): protein and the id of the symbol that its first gene name approves."""
    ids = first_per_key(symbols, ["Approved symbol"], ["ord"]).select(
        F.col("Approved symbol").alias("symbol"), F.col("HGNC ID").alias("object")
    )
    named = proteins.select(_protein_id().alias("subject"), first_word(F.col("Gene Names")).alias("symbol"))
    return named.join(ids, ["symbol"]).select("subject", "object")


def _aspect_terms(column: str, predicate: str) -> Column:
    return F.transform(
        bracket_ids(F.col(f"`{column}`")), lambda term: F.struct(F.lit(predicate).alias("predicate"), term.alias("object"))
    )


def protein_edges(proteins: DataFrame, symbols: DataFrame) -> DataFrame:
    """Gene products and the annotation terms of the three aspects."""
    terms = F.flatten(F.array(*[_aspect_terms(column, predicate) for column, predicate in ASPECTS]))
    annotated = proteins.select(_protein_id().alias("subject"), F.explode(terms).alias("t")).select("subject", "t.*")
    products = symbol_lookup(proteins, symbols).select("subject", F.lit("gene_product_of").alias("predicate"), "object")
    return products.unionByName(annotated)


def protein_nodes(proteins: DataFrame) -> DataFrame:
    """Nodes labelled with the recommended name; synonyms are the entry name and the other names."""
    names = F.col("`Protein names`")
    return proteins.select(
        _protein_id().alias("node_id"),
        recommended_name(names).alias("node_label"),
        F.col("`Function [CC]`").alias("node_definition"),
        F.array_join(F.concat(F.array(F.col("`Entry Name`")), outer_groups(names)), "|").alias("node_synonyms"),
        F.lit("").alias("node_dbxrefs"),
    )
