"""Genome annotation files to edges and nodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import strip_version, version_of
from vocabweave.functions.fixed_values import GTF_KEYS
from vocabweave.functions.text import key_value_pieces, tidy_key_values, values_in_pieces
from vocabweave.operators.keyed import first_per_key
from vocabweave.session import cut_lineage
from vocabweave.sources.tables import union_sources

# Columns of the four metadata files, joined on transcript_id.
METADATA_COLUMNS = {
    "entrez": ["Entrez_Gene_id"],
    "refseq": ["RefSeq_RNA_id", "RefSeq_protein_id"],
    "swissprot": ["UNIPROTKB_SwissProt_AN", "UNIPROTKB_SwissProt_AN2"],
    "trembl": ["UNIPROTKB_TrEMBL_AN", "UNIPROTKB_TrEMBL_AN2"],
}


def filter_features(annotations: DataFrame, feature_types: Sequence[str] = ("all",)) -> DataFrame:
    if list(feature_types) == ["all"]:
        return annotations
    return annotations.where(F.col("feature_type").isin(list(feature_types)))


def filter_columns(annotations: DataFrame, columns: Sequence[str] = ("all",)) -> DataFrame:
    return annotations if list(columns) == ["all"] else annotations.select(*columns)


def split_key_values(annotations: DataFrame, keys: Sequence[str] = GTF_KEYS) -> DataFrame:
    """One column per key of the key-value column; blank where a row lacks the key."""
    cut = annotations.withColumn("column_9", key_value_pieces(tidy_key_values(F.col("column_9"))))
    values = [values_in_pieces(F.col("column_9"), key).alias(key) for key in keys]
    return cut.select(*[c for c in annotations.columns if c != "column_9"], *values)


def enrich(annotations: DataFrame, metadata: dict[str, DataFrame]) -> DataFrame:
    """Annotations with the four metadata files; a transcript may fan out.

    Genes have a blank transcript, which may be a third of all rows; these take no part in the joins.
    """
    whole = annotations.where("transcript_id <> ''")
    for name, columns in METADATA_COLUMNS.items():
        side = metadata[name].select("transcript_id", *columns, F.col("ord").alias(f"{name}_ord"))
        whole = whole.join(side, ["transcript_id"], "left")
    whole = whole.unionByName(annotations.where("coalesce(transcript_id, '') = ''"), allowMissingColumns=True)
    return whole.na.fill("", [c for columns in METADATA_COLUMNS.values() for c in columns])


def _ensembl(accession: str) -> Column:
    return F.concat(F.lit("ENSEMBL:"), strip_version(F.col(accession)))


def first_transcripts(annotations: DataFrame, metadata: dict[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """First row of each transcript, with the first row that each file in ``names`` has for it.

    The first of all combinations is the combination of the firsts, so the files are cut to a
    row per transcript before they meet, and no transcript fans out.
    """
    whole = first_per_key(annotations.where("feature_type = 'transcript'"), ["transcript_id"], ["ord"])
    for name in names:
        side = metadata[name].select("transcript_id", *METADATA_COLUMNS[name], F.col("ord").alias(f"{name}_ord"))
        whole = whole.join(first_per_key(side.where("transcript_id <> ''"), ["transcript_id"], [f"{name}_ord"]), ["transcript_id"], "left")
    return whole


def molecules_of(annotations: DataFrame, metadata: dict[str, DataFrame]) -> DataFrame:
    """Distinct (transcript_id, RefSeq ids) of the transcripts that any row of the annotations names."""
    named = annotations.where("transcript_id <> ''").select("transcript_id").distinct()
    listed = metadata["refseq"].select("transcript_id", *METADATA_COLUMNS["refseq"])
    return listed.where(" OR ".join(f"{name} <> ''" for name in METADATA_COLUMNS["refseq"])).distinct().join(named, ["transcript_id"], "left_semi")


def valueset_codes(values: DataFrame, valueset: DataFrame, value: str = "value") -> DataFrame:
    """``values`` with ``code``: the first value-set node labelled like ``value``; others dropped."""
    # written first: the planner then knows how small they are, and no hot value is shuffled
    codes = cut_lineage(first_per_key(valueset, ["node_label"], ["ord"]).select(
        F.col("node_label").alias(value), F.col("node_id").alias("code")
    ))
    return values.join(codes, [value])


def annotation_edges(annotations: DataFrame, metadata: dict[str, DataFrame], valueset: DataFrame) -> DataFrame:
    """Distinct edges of transcripts and features.

    What the annotations say themselves is read from them as they are; only distinct transcripts
    meet the metadata files, never each of their exons. Value-set objects of all predicates are
    looked up in one join.
    """
    def one(subject: Column, predicate: str, obj: Column, keep: Column) -> Column:
        return F.struct(subject.alias("subject"), F.lit(predicate).alias("predicate"), F.when(keep, obj).alias("object"))

    def exploded(rows: DataFrame, *edges: Column) -> DataFrame:
        return rows.select(F.explode(F.array(*edges)).alias("e")).select("e.*").where("object IS NOT NULL")

    filled = lambda name: F.col(name) != ""
    prefixed = lambda sab, name: F.concat(F.lit(sab + ":"), F.col(name))
    transcript = _ensembl("transcript_id")
    of_transcripts = exploded(
        first_transcripts(annotations, metadata, ["swissprot", "trembl"]),
        one(transcript, "transcribed_from", _ensembl("gene_id"), F.lit(True)),
        *[
            one(transcript, "has_gene_product", prefixed("UNIPROTKB", name), filled(name))
            for name in ("UNIPROTKB_SwissProt_AN", "UNIPROTKB_TrEMBL_AN")
        ],
    )

    feature = F.when(filled("transcript_id"), transcript).otherwise(_ensembl("gene_id"))
    strand = F.when(F.col("genomic_strand") == "+", "positive").when(F.col("genomic_strand") == "-", "negative")
    plain = exploded(
        molecules_of(annotations, metadata),
        *[
            one(transcript, "has_refSeq_ID", prefixed("REFSEQ", name), filled(name))
            for name in ("RefSeq_RNA_id", "RefSeq_protein_id")
        ],
    )
    parents = annotations.where(F.trim("ont") != "").select(feature.alias("feature"), "ont").distinct().select(
        F.col("feature").alias("subject"), F.lit("isa").alias("predicate"), F.explode(F.split("ont", ",")).alias("object")
    )
    # all rows of a feature meet once; its edges are told apart where they lie, without another shuffle
    described = annotations.select(
        feature.alias("subject"), "chromosome_name", "feature_type", "gene_type", "transcript_type", strand.alias("strand")
    ).repartition("subject")

    def says(predicate: str, value: Column, keep: Column = F.lit(True)) -> Column:
        return F.struct(F.lit(predicate).alias("predicate"), F.when(keep, value).alias("value"))

    valued = described.select("subject", F.explode(F.array(
        says("located_in", F.col("chromosome_name")),
        says("is_feature_type", F.col("feature_type")),
        says("is_gene_biotype", F.col("gene_type"), filled("gene_type")),
        says("is_transcript_biotype", F.col("transcript_type"), filled("transcript_type")),
        says("has_directional_form_of", F.col("strand")),
    )).alias("e")).select("subject", "e.*").where("value IS NOT NULL")
    coded = valueset_codes(valued, valueset).select("subject", "predicate", F.col("code").alias("object")).distinct()
    # no predicate stands in both
    return union_sources([union_sources([of_transcripts, plain, parents]).distinct(), coded])


def annotation_nodes(annotations: DataFrame, metadata: dict[str, DataFrame]) -> DataFrame:
    """Nodes of genes, transcripts, Entrez genes and RefSeq molecules with their bounds."""
    blank = F.lit("")

    def node(rows: DataFrame, node_id: Column, label: Column, dbxref: Column = blank, value: Column = blank, located: bool = True) -> DataFrame:
        bound = lambda name: F.col(name).cast("bigint").cast("string") if located else blank
        return rows.select(
            node_id.alias("node_id"), label.alias("node_label"), blank.alias("node_definition"),
            blank.alias("node_synonyms"), dbxref.alias("node_dbxrefs"), value.alias("value"),
            bound("genomic_start_location").alias("lowerbound"),
            bound("genomic_end_location").alias("upperbound"), blank.alias("unit"),
        )

    genes = first_per_key(annotations.where("feature_type = 'gene'"), ["gene_id"], ["ord"])
    # two kinds of nodes read each of these; written, they are worked out once
    transcripts = cut_lineage(first_transcripts(annotations, metadata, ["entrez"]))
    entrez = first_per_key(transcripts.where("Entrez_Gene_id <> ''"), ["Entrez_Gene_id"], ["ord", "entrez_ord"])
    named = cut_lineage(molecules_of(annotations, metadata))
    molecules = [
        node(named.select(name).where(F.col(name) != "").distinct(), F.concat(F.lit("REFSEQ:"), F.col(name)), F.col(name), located=False)
        for name in METADATA_COLUMNS["refseq"]
    ]
    return union_sources([
        node(genes, _ensembl("gene_id"), F.trim("gene_name"), F.col("hgnc_id"), version_of(F.col("gene_id"))),
        node(transcripts, _ensembl("transcript_id"), F.col("transcript_name"), value=version_of(F.col("transcript_id"))),
        node(entrez, F.concat(F.lit("ENTREZ:"), F.col("Entrez_Gene_id").cast("bigint")), F.col("gene_name"), F.col("hgnc_id")),
        *molecules,
    ])
