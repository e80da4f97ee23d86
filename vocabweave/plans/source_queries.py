"""Queries over the jobs that turn sources into edges and nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.functions import codes as code_functions
from vocabweave.functions.fixed_values import (
    OBO_DBXREF, OBO_DEFINITION, OBO_SYNONYM, OWL_AXIOM, OWL_CLASS, OWL_DISJOINT, OWL_EQUIVALENT, OWL_FILLERS,
    OWL_INTERSECTION, OWL_ON_PROPERTY, OWL_PROPERTY, OWL_SOURCE, OWL_TARGET, OWL_UNION, RDF_FIRST, RDF_NIL, RDF_REST,
    RDF_TYPE, RDFS_LABEL, RDFS_SUBCLASS, TEMPLATE_PARENT,
)
from vocabweave.operators.keyed import list_rows
from vocabweave.plans.catalog import VIEWS, Inputs, query
from vocabweave.plans.table_queries import relation_tables
from vocabweave.session import cut_lineage
from vocabweave.sources import annotations, crosswalk, field_vocabulary, oneshot, pathways, proteins, sheets, triples

# ---- annotations -------------------------------------------------------------------------

VIEWS["fx_gtf_flat"] = """
SELECT 'gene' AS feature_type, concat('chr', CAST(p_size AS STRING)) AS chromosome_name, p_partkey * 10 AS lo, p_partkey * 10 + p_size AS hi,
       CASE p_type WHEN 'PROMO' THEN '.' WHEN 'LARGE' THEN '-' ELSE '+' END AS genomic_strand,
       concat('ENSG', lpad(CAST(p_partkey AS STRING), 8, '0'), '.', CAST(p_size AS STRING)) AS gene_id, '' AS transcript_id, p_type AS gene_type,
       p_brand AS gene_name, '' AS transcript_type, '' AS transcript_name, '' AS ont,
       CASE p_type WHEN 'SMALL' THEN '' ELSE concat('HGNC:', CAST(p_partkey AS STRING)) END AS hgnc_id, p_partkey AS ord FROM part
UNION ALL
SELECT CASE l_linenumber WHEN 7 THEN 'exon' ELSE 'transcript' END, concat('chr', CAST(p_size AS STRING)), p_partkey * 10, p_partkey * 10 + l_linenumber,
       CASE p_type WHEN 'PROMO' THEN '.' WHEN 'LARGE' THEN '-' ELSE '+' END,
       concat('ENSG', lpad(CAST(p_partkey AS STRING), 8, '0'), '.', CAST(p_size AS STRING)),
       concat('ENST', lpad(CAST(l_orderkey AS STRING), 9, '0'), '.', CAST(l_linenumber AS STRING)), p_type, p_brand,
       concat('type', CAST(l_linenumber AS STRING)), concat('T-', CAST(l_orderkey AS STRING)),
       CASE l_linenumber WHEN 5 THEN 'PGO:1,PGO:2' ELSE '' END, concat('HGNC:', CAST(p_partkey AS STRING)),
       1000000000 + (l_orderkey * 10 + l_linenumber) * 1000000 + p_partkey
FROM lineitem JOIN part ON l_partkey = p_partkey"""
VIEWS["fx_gtf"] = """
SELECT chromosome_name, 'src' AS annotation_source, feature_type, CAST(lo AS STRING) AS genomic_start_location, CAST(hi AS STRING) AS genomic_end_location,
       '.' AS score, genomic_strand, '.' AS genomic_phase, concat('gene_id "', gene_id, '"; ',
       CASE WHEN transcript_id = '' THEN '' ELSE concat('transcript_id "', transcript_id, '"; transcript_type "', transcript_type, '"; transcript_name "', transcript_name, '"; ') END,
       'gene_type "', gene_type, '"; gene_name "', gene_name, '"; ', CASE WHEN ont = '' THEN '' ELSE 'ont "PGO:1"; ont "PGO:2"; ' END,
       CASE WHEN hgnc_id = '' THEN '' ELSE concat('hgnc_id "', hgnc_id, '";') END) AS column_9, ord FROM fx_gtf_flat"""
VIEWS["fx_entrez"] = """
SELECT concat('ENST', lpad(CAST(o_orderkey AS STRING), 9, '0'), '.1') AS transcript_id, CAST(o_custkey AS STRING) AS Entrez_Gene_id, o_orderkey AS ord FROM orders"""
VIEWS["fx_refseq"] = """
SELECT concat('ENST', lpad(CAST(o_orderkey AS STRING), 9, '0'), '.2') AS transcript_id, concat('NM_', CAST(o_custkey AS STRING)) AS RefSeq_RNA_id,
       CASE o_orderstatus WHEN 'P' THEN '' ELSE concat('NP_', CAST(o_custkey AS STRING)) END AS RefSeq_protein_id, o_orderkey AS ord FROM orders
UNION ALL SELECT concat('ENST', lpad(CAST(o_orderkey AS STRING), 9, '0'), '.2'), concat('NR_', CAST(o_orderkey AS STRING)), '', 1000000000 + o_orderkey FROM orders"""
VIEWS["fx_swissprot"] = """
SELECT concat('ENST', lpad(CAST(o_orderkey AS STRING), 9, '0'), '.1') AS transcript_id, concat('P', CAST(o_custkey AS STRING)) AS UNIPROTKB_SwissProt_AN,
       'x' AS UNIPROTKB_SwissProt_AN2, o_orderkey AS ord FROM orders"""
VIEWS["fx_trembl"] = """
SELECT concat('ENST', lpad(CAST(o_orderkey AS STRING), 9, '0'), '.3') AS transcript_id, concat('Q', CAST(o_orderkey AS STRING)) AS UNIPROTKB_TrEMBL_AN,
       'x' AS UNIPROTKB_TrEMBL_AN2, o_orderkey AS ord FROM orders"""
VIEWS["fx_valueset"] = """
SELECT p_type AS node_label, concat('VS:P', CAST(p_partkey AS STRING)) AS node_id, p_partkey AS ord FROM part
UNION ALL SELECT concat('chr', CAST(n_nationkey AS STRING)), concat('VS:C', CAST(n_nationkey AS STRING)), 1000000000 + n_nationkey FROM nation
UNION ALL SELECT CASE r_regionkey WHEN 0 THEN 'gene' WHEN 1 THEN 'transcript' WHEN 2 THEN 'positive' WHEN 3 THEN 'negative' ELSE 'type3' END,
       concat('VS:R', CAST(r_regionkey AS STRING)), 2000000000 + r_regionkey FROM region"""

VIEWS["ox_enriched"] = """
SELECT g.*, coalesce(Entrez_Gene_id, '') AS entrez, coalesce(RefSeq_RNA_id, '') AS rna, coalesce(RefSeq_protein_id, '') AS prot,
       coalesce(UNIPROTKB_SwissProt_AN, '') AS sp, coalesce(UNIPROTKB_TrEMBL_AN, '') AS tr, r.ord AS r_ord,
       CASE WHEN g.transcript_id <> '' THEN concat('ENSEMBL:', split_part(g.transcript_id, '.', 1)) ELSE concat('ENSEMBL:', split_part(g.gene_id, '.', 1)) END AS feature
FROM fx_gtf_flat g LEFT JOIN fx_entrez e ON g.transcript_id = e.transcript_id LEFT JOIN fx_refseq r ON g.transcript_id = r.transcript_id
LEFT JOIN fx_swissprot s ON g.transcript_id = s.transcript_id LEFT JOIN fx_trembl t ON g.transcript_id = t.transcript_id"""
VIEWS["ox_first_transcripts"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY ord, r_ord NULLS FIRST) AS rn FROM ox_enriched WHERE feature_type = 'transcript') WHERE rn = 1"""
VIEWS["ox_valueset"] = "SELECT node_label, arg_min(node_id, ord) AS code FROM fx_valueset GROUP BY node_label"

GTF_KEYS_USED = ["gene_id", "transcript_id", "gene_type", "gene_name", "transcript_type", "transcript_name", "ont", "hgnc_id"]


def parsed(inputs: Inputs) -> DataFrame:
    landed = cut_lineage(annotations.filter_features(inputs.view("fx_gtf")), spread=True)
    return cut_lineage(annotations.split_key_values(landed, GTF_KEYS_USED))


def metadata(inputs: Inputs) -> dict[str, DataFrame]:
    return {name: inputs.view(f"fx_{name}") for name in annotations.METADATA_COLUMNS}


@query("annotation_enrich", "SELECT feature_type, gene_id, transcript_id, ont, hgnc_id, entrez, rna, prot, sp, tr FROM ox_enriched")
def annotation_enrich(inputs: Inputs) -> DataFrame:
    return annotations.enrich(parsed(inputs), metadata(inputs)).select(
        "feature_type", "gene_id", "transcript_id", "ont", "hgnc_id", F.col("Entrez_Gene_id").alias("entrez"), F.col("RefSeq_RNA_id").alias("rna"),
        F.col("RefSeq_protein_id").alias("prot"), F.col("UNIPROTKB_SwissProt_AN").alias("sp"), F.col("UNIPROTKB_TrEMBL_AN").alias("tr"),
    )


@query("annotation_edges", """
WITH v AS (
  SELECT feature, 'located_in' AS predicate, chromosome_name AS value FROM ox_enriched UNION SELECT feature, 'is_feature_type', feature_type FROM ox_enriched
  UNION SELECT feature, 'is_gene_biotype', gene_type FROM ox_enriched UNION SELECT feature, 'is_transcript_biotype', transcript_type FROM ox_enriched
  UNION SELECT feature, 'has_directional_form_of', CASE genomic_strand WHEN '+' THEN 'positive' WHEN '-' THEN 'negative' END FROM ox_enriched)
SELECT concat('ENSEMBL:', split_part(transcript_id, '.', 1)) AS subject, 'transcribed_from' AS predicate, concat('ENSEMBL:', split_part(gene_id, '.', 1)) AS object FROM ox_first_transcripts
UNION SELECT feature, 'has_gene_product', concat('UNIPROTKB:', sp) FROM ox_first_transcripts WHERE sp <> ''
UNION SELECT feature, 'has_gene_product', concat('UNIPROTKB:', tr) FROM ox_first_transcripts WHERE tr <> ''
UNION SELECT feature, 'has_refSeq_ID', concat('REFSEQ:', rna) FROM ox_enriched WHERE rna <> ''
UNION SELECT feature, 'has_refSeq_ID', concat('REFSEQ:', prot) FROM ox_enriched WHERE prot <> ''
UNION SELECT feature, 'isa', unnest(string_split(ont, ',')) FROM ox_enriched WHERE ont <> ''
UNION SELECT v.feature, v.predicate, s.code FROM v JOIN ox_valueset s ON s.node_label = v.value
""")
def annotation_edges(inputs: Inputs) -> DataFrame:
    return annotations.annotation_edges(parsed(inputs), metadata(inputs), inputs.view("fx_valueset"))


@query("annotation_nodes", """
WITH g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY ord) AS rn FROM ox_enriched WHERE feature_type = 'gene') WHERE rn = 1),
e AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY entrez ORDER BY ord) AS rn FROM ox_first_transcripts WHERE entrez <> '') WHERE rn = 1)
SELECT concat('ENSEMBL:', split_part(gene_id, '.', 1)) AS node_id, gene_name AS node_label, hgnc_id AS node_dbxrefs, split_part(gene_id, '.', 2) AS value,
  CAST(lo AS STRING) AS lowerbound, CAST(hi AS STRING) AS upperbound FROM g
UNION ALL SELECT feature, transcript_name, '', split_part(transcript_id, '.', 2), CAST(lo AS STRING), CAST(hi AS STRING) FROM ox_first_transcripts
UNION ALL SELECT concat('ENTREZ:', entrez), gene_name, hgnc_id, '', CAST(lo AS STRING), CAST(hi AS STRING) FROM e
UNION ALL SELECT DISTINCT concat('REFSEQ:', rna), rna, '', '', '', '' FROM ox_enriched WHERE rna <> ''
UNION ALL SELECT DISTINCT concat('REFSEQ:', prot), prot, '', '', '', '' FROM ox_enriched WHERE prot <> ''
""")
def annotation_nodes(inputs: Inputs) -> DataFrame:
    return annotations.annotation_nodes(parsed(inputs), metadata(inputs)).select(
        "node_id", "node_label", "node_dbxrefs", "value", "lowerbound", "upperbound"
    )


VIEWS["fx_typed_values"] = "SELECT l_orderkey, l_partkey, p_type AS value FROM lineitem JOIN part ON l_partkey = p_partkey UNION ALL SELECT o_orderkey, 0, o_orderstatus FROM orders"


@query("valueset_lookup", "SELECT l_orderkey, l_partkey, value, code FROM fx_typed_values JOIN ox_valueset ON node_label = value")
def valueset_lookup(inputs: Inputs) -> DataFrame:
    return annotations.valueset_codes(inputs.view("fx_typed_values"), inputs.view("fx_valueset")).select("l_orderkey", "l_partkey", "value", "code")


# ---- proteins ----------------------------------------------------------------------------

VIEWS["fx_protein_rows"] = """
SELECT CAST(c_custkey AS STRING) AS entry, concat('E', CAST(c_custkey AS STRING), '_X') AS entry_name,
       concat(c_mktsegment, ' protein (', c_name, ') (N(', CAST(c_nationkey AS STRING), '))') AS names, concat('N', CAST(c_nationkey AS STRING), ' syn') AS genes,
       concat('about ', c_name) AS about, concat(c_mktsegment, ' [GO:', CAST(c_custkey AS STRING), ']; other [GO:', CAST(c_nationkey AS STRING), ']') AS go_p,
       CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE concat('part [GO:C', CAST(c_nationkey AS STRING), ']') END AS go_c, 'none' AS go_f FROM customer"""
VIEWS["fx_symbols"] = "SELECT concat('HGNC:', CAST(s_suppkey AS STRING)) AS id, concat('N', CAST(s_nationkey AS STRING)) AS symbol, s_suppkey AS ord FROM supplier"


def protein_rows(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_protein_rows").withColumnsRenamed({
        "entry": "Entry", "entry_name": "Entry Name", "names": "Protein names", "genes": "Gene Names", "about": "Function [CC]",
        "go_p": proteins.ASPECTS[0][0], "go_c": proteins.ASPECTS[1][0], "go_f": proteins.ASPECTS[2][0],
    })


def symbols(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_symbols").withColumnsRenamed({"id": "HGNC ID", "symbol": "Approved symbol"})


VIEWS["ox_products"] = """
SELECT concat('UNIPROTKB:', entry) AS subject, id AS object FROM fx_protein_rows JOIN (SELECT symbol, arg_min(id, ord) AS id FROM fx_symbols GROUP BY symbol) s
ON s.symbol = split_part(genes, ' ', 1)"""


@query("symbol_lookup", "SELECT subject, object FROM ox_products")
def symbol_lookup(inputs: Inputs) -> DataFrame:
    return proteins.symbol_lookup(protein_rows(inputs), symbols(inputs))


@query("protein_edges", """
SELECT subject, 'gene_product_of' AS predicate, object FROM ox_products
UNION ALL SELECT concat('UNIPROTKB:', entry), 'involved_in', concat('GO:', entry) FROM fx_protein_rows
UNION ALL SELECT concat('UNIPROTKB:', entry), 'involved_in', concat('GO:', CAST(c_nationkey AS STRING)) FROM fx_protein_rows JOIN customer ON CAST(c_custkey AS STRING) = entry
UNION ALL SELECT concat('UNIPROTKB:', entry), 'part_of', concat('GO:C', CAST(c_nationkey AS STRING)) FROM fx_protein_rows JOIN customer ON CAST(c_custkey AS STRING) = entry WHERE c_mktsegment <> 'BUILDING'
""")
def protein_edges(inputs: Inputs) -> DataFrame:
    return proteins.protein_edges(protein_rows(inputs), symbols(inputs))


@query("protein_nodes", """
SELECT concat('UNIPROTKB:', CAST(c_custkey AS STRING)) AS node_id, concat(c_mktsegment, ' protein') AS node_label, concat('about ', c_name) AS node_definition,
  concat('E', CAST(c_custkey AS STRING), '_X|', c_name, '|N(', CAST(c_nationkey AS STRING), ')') AS node_synonyms, '' AS node_dbxrefs FROM customer
""")
def protein_nodes(inputs: Inputs) -> DataFrame:
    return proteins.protein_nodes(protein_rows(inputs))


# ---- pathways ----------------------------------------------------------------------------

VIEWS["fx_trees"] = """
SELECT CAST(c_nationkey AS STRING) AS taxon, concat('{"stId":"C', k, '","type":"TopLevelPathway","children":[{"stId":"C', k, '.S","type":"Pathway","children":[{"stId":"C', k,
       '.R","type":"Reaction"},{"stId":"C', k, '.P","type":"Polymerisation"}]},{"stId":"C', k, '.B","type":"BlackBoxEvent","children":[]}]}') AS body
FROM (SELECT *, CAST(c_custkey AS STRING) AS k FROM customer) c"""
VIEWS["fx_event_details"] = """
SELECT concat('C', k, CASE c_mktsegment WHEN 'BUILDING' THEN '.S' ELSE '' END) AS id, concat('{"displayName":"', c_name, '",',
       CASE WHEN c_nationkey > 10 THEN concat('"goBiologicalProcess":{"accession":"', CAST(c_nationkey AS STRING), '"},') ELSE '' END,
       '"compartment":[{"accession":"A', k, '"},{"accession":"B"}],"precedingEvent":[{"stId":"C0"},5]}') AS body
FROM (SELECT *, CAST(c_custkey AS STRING) AS k FROM customer) c"""
VIEWS["fx_participants"] = """
SELECT concat('C', CAST(o_custkey AS STRING), CASE o_orderstatus WHEN 'P' THEN '.R' WHEN 'F' THEN '.B' ELSE '.S' END) AS id,
       concat('[{"className":"ReferenceGeneProduct","databaseName":"UniProt","identifier":"P', CAST(o_orderkey AS STRING),
       '"},{"className":"Molecule","databaseName":"ChEBI","identifier":"', CAST(o_custkey AS STRING), '"}]') AS body FROM orders"""
VIEWS["fx_event_types"] = """
SELECT CASE r_regionkey WHEN 0 THEN 'BlackBoxEvent' WHEN 1 THEN 'Reaction' WHEN 2 THEN 'Pathway' WHEN 3 THEN 'TopLevelPathway' ELSE 'x' END AS node_label,
       CASE r_regionkey WHEN 0 THEN 'REACTOME_VS:C0006' WHEN 1 THEN 'REACTOME_VS:C0011' WHEN 2 THEN 'REACTOME_VS:C0002' WHEN 3 THEN 'REACTOME_VS:C0001' ELSE 'REACTOME_VS:C0099' END AS node_id,
       r_regionkey AS ord FROM region"""
VIEWS["ox_events"] = """
SELECT CAST(c_nationkey AS STRING) AS taxon, concat('C', CAST(c_custkey AS STRING)) AS k, concat('C', CAST(c_custkey AS STRING), e.suffix) AS id,
       CASE WHEN e.parent IS NULL THEN NULL ELSE concat('C', CAST(c_custkey AS STRING), e.parent) END AS parent, e.type, e.depth
FROM customer, (VALUES ('', NULL, 'TopLevelPathway', 0), ('.S', '', 'Pathway', 1), ('.B', '', 'BlackBoxEvent', 1), ('.R', '.S', 'Reaction', 2), ('.P', '.S', 'Polymerisation', 2)) e(suffix, parent, type, depth)"""


@query("tree_flatten", "SELECT taxon, parent, id, type, depth FROM ox_events")
def tree_flatten(inputs: Inputs) -> DataFrame:
    return pathways.flatten_trees(inputs.view("fx_trees"), "body", ["taxon"])


VIEWS["ox_pathway_edges"] = """
SELECT concat('REACTOME:', id) AS subject, 'isa' AS predicate, node_id AS object FROM ox_events JOIN fx_event_types ON node_label = type
UNION ALL SELECT concat('REACTOME:', parent), 'causally_related_to', concat('REACTOME:', id) FROM ox_events WHERE parent IS NOT NULL
UNION ALL SELECT concat('REACTOME:', id), 'in_taxon', concat('NCBI:', taxon) FROM ox_events
UNION ALL SELECT concat('REACTOME:', id), 'involved_in', concat('GO:', json_extract_string(body, '$.goBiologicalProcess.accession')) FROM fx_event_details WHERE contains(body, 'goBio')
UNION ALL SELECT concat('REACTOME:', id), 'part_of', concat('GO:', json_extract_string(body, '$.compartment[0].accession')) FROM fx_event_details
UNION ALL SELECT concat('REACTOME:', id), 'part_of', 'GO:B' FROM fx_event_details
UNION ALL SELECT concat('REACTOME:', id), 'preceded_by', 'REACTOME:C0' FROM fx_event_details
UNION ALL SELECT concat('REACTOME:', id), 'has_participant', concat('UNIPROTKB:', json_extract_string(body, '$[0].identifier')) FROM fx_participants WHERE id NOT LIKE '%.S'
UNION ALL SELECT concat('REACTOME:', id), 'has_participant', concat('CHEBI:', json_extract_string(body, '$[1].identifier')) FROM fx_participants WHERE id NOT LIKE '%.S'"""


def all_pathway_edges(inputs: Inputs) -> DataFrame:
    return pathways.pathway_edges(*[inputs.view(v) for v in ("fx_trees", "fx_event_details", "fx_participants", "fx_event_types")])


@query("pathway_edges", "SELECT * FROM ox_pathway_edges")
def pathway_edges(inputs: Inputs) -> DataFrame:
    return all_pathway_edges(inputs)


@query("pathway_nodes", """
SELECT s.subject AS node_id, coalesce(json_extract_string(body, '$.displayName'), '') AS node_label FROM (SELECT DISTINCT subject FROM ox_pathway_edges) s
LEFT JOIN fx_event_details d ON s.subject = concat('REACTOME:', d.id)
""")
def pathway_nodes(inputs: Inputs) -> DataFrame:
    return pathways.pathway_nodes(all_pathway_edges(inputs), inputs.view("fx_event_details")).select("node_id", "node_label")


# ---- crosswalk and hierarchy -------------------------------------------------------------

VIEWS["fx_crosswalk_rows"] = """
SELECT p_brand AS organ_level, concat('UBERON:', CAST(p_size AS STRING)) AS organ_id, p_name AS label,
       CASE p_type WHEN 'PROMO' THEN '' ELSE concat('AZ:', CAST(p_partkey AS STRING)) END AS label_id, concat('CL:', CAST(p_size AS STRING)) AS cl_id, p_partkey AS ord FROM part"""
VIEWS["ox_levels"] = """
SELECT organ_level, organ_id, concat('AZ:', CAST(1000000 + row_number() OVER (ORDER BY ord) AS STRING)) AS level_id FROM
  (SELECT organ_level, arg_min(organ_id, ord) AS organ_id, min(ord) AS ord FROM fx_crosswalk_rows GROUP BY organ_level)"""


def crosswalk_rows(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_crosswalk_rows").withColumnsRenamed({
        "organ_level": "Organ_Level", "organ_id": "Organ_ID", "label": "Annotation_Label", "label_id": "Annotation_Label_ID", "cl_id": "CL_ID",
    })


@query("crosswalk_edges", """
SELECT 'AZ:1000000' AS subject, 'isa' AS predicate, 'AZ:0000000' AS object UNION ALL SELECT 'AZ:2000000', 'isa', 'AZ:0000000'
UNION ALL SELECT level_id, 'isa', 'AZ:1000000' FROM ox_levels UNION ALL SELECT level_id, 'part_of', organ_id FROM ox_levels
UNION ALL SELECT label_id, 'isa', 'AZ:2000000' FROM fx_crosswalk_rows WHERE label_id <> ''
UNION ALL SELECT label_id, 'located_in', level_id FROM fx_crosswalk_rows JOIN ox_levels USING (organ_level) WHERE label_id <> ''
""")
def crosswalk_edges(inputs: Inputs) -> DataFrame:
    return crosswalk.crosswalk_edges(crosswalk_rows(inputs), "AZ")


@query("crosswalk_nodes", """
SELECT 'AZ:0000000' AS node_id, 'AZ' AS node_label, '' AS node_synonyms, '' AS node_dbxrefs
UNION ALL SELECT 'AZ:1000000', 'AZ_organ_level', '', '' UNION ALL SELECT 'AZ:2000000', 'AZ_cell_annotation', '', ''
UNION ALL SELECT level_id, concat('AZ_', organ_level), '', '' FROM ox_levels
UNION ALL SELECT label_id, concat('AZ_', organ_level, '_', label), label, cl_id FROM fx_crosswalk_rows WHERE label_id <> ''
""")
def crosswalk_nodes(inputs: Inputs) -> DataFrame:
    return crosswalk.crosswalk_nodes(crosswalk_rows(inputs), "AZ").select("node_id", "node_label", "node_synonyms", "node_dbxrefs")


VIEWS["fx_hierarchy"] = """
SELECT p_type AS organ_label, concat('http://x.org/obo/UBERON_', CAST(p_partkey AS STRING)) AS organ_iri, p_brand AS ftu_label,
       concat('http://x.org/obo/FTU_', CAST(p_partkey AS STRING)) AS ftu_iri, p_name AS ftu_part_label,
       concat('http://x.org/obo/PT_', CAST(p_partkey AS STRING)) AS ftu_part_iri, p_partkey AS ord FROM part"""
VIEWS["ox_hierarchy_rows"] = "SELECT *, row_number() OVER (ORDER BY ord) AS n FROM fx_hierarchy"
#: Offsets with room for every row of the largest table.
WIDE_LEVELS = [(label, iri, offset * 1000, name) for label, iri, offset, name in crosswalk.HIERARCHY_LEVELS]
_levels = [level[:3] for level in WIDE_LEVELS]
VIEWS["ox_hierarchy_ids"] = " UNION ALL ".join(
    f"SELECT '{label}' AS level, label, iri, concat('FTU2D:', CAST({offset} + n AS STRING)) AS id FROM (SELECT {label} AS label, {iri} AS iri, n, "
    f"row_number() OVER (PARTITION BY {label} ORDER BY organ_label, ftu_label, ftu_part_label, n) AS rn FROM ox_hierarchy_rows) WHERE rn = 1"
    for label, iri, offset in _levels
)


@query("hierarchy_edges", """
SELECT 'FTU2D:100000000' AS subject, 'isa' AS predicate, 'FTU2D:000000' AS object UNION ALL SELECT 'FTU2D:200000000', 'isa', 'FTU2D:000000' UNION ALL SELECT 'FTU2D:300000000', 'isa', 'FTU2D:000000'
UNION ALL SELECT id, 'isa', CASE level WHEN 'organ_label' THEN 'FTU2D:100000000' WHEN 'ftu_label' THEN 'FTU2D:200000000' ELSE 'FTU2D:300000000' END FROM ox_hierarchy_ids
UNION ALL SELECT DISTINCT a.id, 'has_ftu', b.id FROM fx_hierarchy h JOIN ox_hierarchy_ids a ON a.level = 'organ_label' AND a.label = organ_label JOIN ox_hierarchy_ids b ON b.level = 'ftu_label' AND b.label = ftu_label
UNION ALL SELECT DISTINCT a.id, 'has_ftu_part', b.id FROM fx_hierarchy h JOIN ox_hierarchy_ids a ON a.level = 'ftu_label' AND a.label = ftu_label JOIN ox_hierarchy_ids b ON b.level = 'ftu_part_label' AND b.label = ftu_part_label
""")
def hierarchy_edges(inputs: Inputs) -> DataFrame:
    return crosswalk.hierarchy_edges(inputs.view("fx_hierarchy"), "FTU2D", levels=WIDE_LEVELS)


@query("hierarchy_nodes", """
SELECT 'FTU2D:000000' AS node_id, 'FTU2D' AS node_label, '' AS node_dbxrefs UNION ALL SELECT 'FTU2D:100000000', 'FTU2D organ', ''
UNION ALL SELECT 'FTU2D:200000000', 'FTU2D ftu', '' UNION ALL SELECT 'FTU2D:300000000', 'FTU2D ftu_part', ''
UNION ALL SELECT id, label, replace(split_part(iri, '/', -1), '_', ':') FROM ox_hierarchy_ids
""")
def hierarchy_nodes(inputs: Inputs) -> DataFrame:
    return crosswalk.hierarchy_nodes(inputs.view("fx_hierarchy"), "FTU2D", levels=WIDE_LEVELS).select("node_id", "node_label", "node_dbxrefs")


# ---- sheets ------------------------------------------------------------------------------

VIEWS["fx_classes"] = """
SELECT concat('http://purl.obolibrary.org/obo/XCO_', CAST(p_partkey AS STRING)) AS class_id, p_name AS label, p_type AS definition,
       CASE p_type WHEN 'PROMO' THEN 'nan' ELSE p_brand END AS synonyms,
       CASE p_type WHEN 'PROMO' THEN 'nan' WHEN 'SMALL' THEN 'http://purl.obolibrary.org/obo/XCO_0' ELSE concat('http://purl.obolibrary.org/obo/XCO_', CAST(p_size AS STRING), '||http://purl.obolibrary.org/obo/XCO_1') END AS parents,
       CASE p_type WHEN 'LARGE' THEN concat('http://purl.obolibrary.org/obo/CHEBI_', CAST(p_size AS STRING)) ELSE NULL END AS has_component FROM part"""


def class_rows(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_classes").withColumnsRenamed({"class_id": "Class ID", "label": "Preferred Label", "synonyms": "Synonyms", "parents": "Parents"})


@query("class_table_edges", """
SELECT replace(split_part(class_id, '/', -1), '_', ':') AS subject, 'isa' AS predicate, replace(split_part(p, '/', -1), '_', ':') AS object
FROM (SELECT class_id, unnest(string_split(parents, '|')) AS p FROM fx_classes WHERE parents <> 'nan') WHERE p <> ''
UNION ALL SELECT replace(split_part(class_id, '/', -1), '_', ':'), 'has_component', replace(split_part(has_component, '/', -1), '_', ':') FROM fx_classes WHERE has_component IS NOT NULL
""")
def class_table_edges(inputs: Inputs) -> DataFrame:
    return sheets.class_table_edges(class_rows(inputs), "XCO")


@query("class_table_nodes", """
SELECT replace(split_part(class_id, '/', -1), '_', ':') AS node_id, label AS node_label, definition AS node_definition,
  CASE synonyms WHEN 'nan' THEN 'None' ELSE synonyms END AS node_synonyms, 'None' AS node_dbxrefs FROM fx_classes
""")
def class_table_nodes(inputs: Inputs) -> DataFrame:
    return sheets.class_table_nodes(class_rows(inputs), "XCO")


VIEWS["fx_term_sheet"] = """
SELECT c_name AS term, concat('SK:', CAST(c_custkey AS STRING)) AS code, 'd' AS definition, c_mktsegment AS synonyms, 'nan' AS dbxrefs,
       concat('Customer#', lpad(CAST(c_nationkey AS STRING), 9, '0')) AS parent,
       CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE concat('Customer#', lpad(CAST(c_nationkey + 1 AS STRING), 9, '0'), ',Customer#000000007') END AS part_of, c_custkey AS ord FROM customer"""
VIEWS["ox_sheet_rows"] = """
SELECT code AS subject, 'isa' AS predicate, parent AS term FROM fx_term_sheet
UNION ALL SELECT code, 'part_of', unnest(string_split(part_of, ',')) FROM fx_term_sheet WHERE part_of <> ''"""


@query("unpivot_relations", "SELECT * FROM ox_sheet_rows")
def unpivot_relations(inputs: Inputs) -> DataFrame:
    return sheets.unpivot_relations(inputs.view("fx_term_sheet"))


VIEWS["ox_sheet_codes"] = "SELECT r.subject, r.predicate, r.term, s.code AS object FROM ox_sheet_rows r JOIN fx_term_sheet s ON s.term = r.term"


@query("term_to_code", "SELECT * FROM ox_sheet_codes")
def term_to_code(inputs: Inputs) -> DataFrame:
    sheet = inputs.view("fx_term_sheet")
    return sheets.term_codes(sheets.unpivot_relations(sheet), sheet).select("subject", "predicate", "term", "object")


@query("term_sheet_edges", "SELECT subject, predicate, object FROM ox_sheet_codes")
def term_sheet_edges(inputs: Inputs) -> DataFrame:
    return sheets.term_sheet_edges(inputs.view("fx_term_sheet"), "SK", *relation_tables(inputs))


VIEWS["fx_template_edges"] = f"""
SELECT concat('https://repo.metadatacenter.org/templates/', CAST(doc_id AS STRING)) AS subject,
       CASE lang WHEN 'en' THEN '{TEMPLATE_PARENT}' WHEN 'fr' THEN '{TEMPLATE_PARENT}' ELSE 'other' END AS object FROM documents"""
VIEWS["fx_template_entities"] = """
SELECT concat('CEDAR:', CAST(doc_id AS STRING)) AS id, concat('A:', CAST(quality AS STRING)) AS first_entity,
       CASE toxic WHEN 1 THEN '' ELSE 'B:0' END AS second_entity, doc_id AS ord FROM labels"""


@query("default_mapping", f"""
WITH t AS (SELECT concat('CEDAR:', split_part(subject, '/', -1)) AS subject FROM fx_template_edges WHERE object = '{TEMPLATE_PARENT}')
SELECT subject, 'used_in_entity' AS predicate, object FROM (
  SELECT subject, first_entity AS object FROM t JOIN fx_template_entities ON id = subject UNION ALL SELECT subject, second_entity FROM t JOIN fx_template_entities ON id = subject
  UNION ALL SELECT subject, 'HUBMAP:C040001' FROM t WHERE subject NOT IN (SELECT id FROM fx_template_entities)
  UNION ALL SELECT subject, 'SENNET:C050002' FROM t WHERE subject NOT IN (SELECT id FROM fx_template_entities)) WHERE object <> ''
""")
def default_mapping(inputs: Inputs) -> DataFrame:
    return sheets.template_entity_map(inputs.view("fx_template_edges"), inputs.view("fx_template_entities"), ["first_entity", "second_entity"])


VIEWS["fx_summaries"] = "SELECT doc_id AS uid, CASE WHEN source = 'src1' THEN '' ELSE text END AS summary FROM documents"
VIEWS["fx_concept_codes"] = """
SELECT concat('ENTREZ:', CAST(doc_id AS STRING)) AS code, concat('UMLS:', source) AS cui FROM documents UNION ALL SELECT concat('ENTREZ:', CAST(doc_id AS STRING)), concat('UMLS:', lang) FROM documents"""
_atui = "translate(base64(encode(concat('ENTREZ ', {0}, ' CUI'))), '+/', '-_')"


@query("append_new_defs", f"""
WITH f AS (SELECT DISTINCT {_atui.format("summary")} AS atui, summary AS def, concat('ENTREZ:', CAST(uid AS STRING)) AS code FROM fx_summaries WHERE summary <> ''),
d AS (SELECT {_atui.format("text")} AS atui FROM documents WHERE lang = 'fr'), l AS (SELECT {_atui.format("text")} AS atui FROM documents WHERE lang = 'de')
SELECT DISTINCT 'definition' AS kind, atui, def AS value FROM f WHERE atui NOT IN (SELECT atui FROM d)
UNION ALL SELECT DISTINCT 'link', atui, cui FROM f JOIN fx_concept_codes c USING (code) WHERE atui NOT IN (SELECT atui FROM l)
""")
def append_new_defs(inputs: Inputs) -> DataFrame:
    found = sheets.definition_rows(inputs.view("fx_summaries"))
    have = inputs.table("documents").select(code_functions.text_id(F.col("text")).alias("atui"), "lang")
    new = sheets.new_definitions(found, have.where("lang = 'fr'"))
    links = sheets.new_definition_links(found, have.where("lang = 'de'"), inputs.view("fx_concept_codes"))
    return new.select(F.lit("definition").alias("kind"), "atui", F.col("def").alias("value")).unionByName(
        links.select(F.lit("link").alias("kind"), "atui", F.col("cui").alias("value"))
    )



@query("restandardize", """
SELECT 'edge' AS kind, subject AS a, relation_label AS b, replace(object, 'PART_', 'PART:') AS c FROM fx_raw_edges JOIN ox_relation_names USING (predicate)
UNION ALL SELECT 'node', concat('CUST:', CAST(c_custkey AS STRING)), c_name, '' FROM customer
""")
def restandardize(inputs: Inputs) -> DataFrame:
    nodes = inputs.sql("SELECT concat('http://x.org/obo/CUST_', CAST(c_custkey AS STRING)) AS node_id, 'CUST' AS node_namespace, c_name AS node_label FROM customer")
    edges, spelled = sheets.restandardize(inputs.view("fx_raw_edges"), nodes, "X", *relation_tables(inputs))
    return edges.select(F.lit("edge").alias("kind"), F.col("subject").alias("a"), F.col("predicate").alias("b"), F.col("object").alias("c")).unionByName(
        spelled.select(F.lit("node").alias("kind"), F.col("node_id").alias("a"), F.col("node_label").alias("b"), F.lit("").alias("c"))
    )


# ---- triples -----------------------------------------------------------------------------

_nation = "concat('http://x.org/obo/NAT_', CAST(n_nationkey AS STRING))"
_region = "concat('http://x.org/obo/', CAST({0} AS STRING))"
_cust = "concat('http://x.org/obo/CUST_', CAST(c_custkey AS STRING))"
_axiom = "concat('_:axiom', CAST(s_suppkey AS STRING))"
VIEWS["fx_triples"] = f"""
SELECT {_nation} AS s, '{RDF_TYPE}' AS p, '{OWL_CLASS}' AS o FROM nation
UNION ALL SELECT {_region.format("r_regionkey")}, '{RDF_TYPE}', '{OWL_CLASS}' FROM region
UNION ALL SELECT {_cust}, '{RDF_TYPE}', CASE c_mktsegment WHEN 'BUILDING' THEN 'http://x.org/Individual' ELSE '{OWL_CLASS}' END FROM customer
UNION ALL SELECT {_nation}, '{RDFS_LABEL}', n_name FROM nation
UNION ALL SELECT {_cust}, '{OBO_DEFINITION}', c_name FROM customer
UNION ALL SELECT {_cust.replace("c_custkey", "o_custkey")}, '{OBO_SYNONYM}', o_orderpriority FROM orders
UNION ALL SELECT {_nation.replace("n_nationkey", "c_nationkey")}, '{OBO_DBXREF}', concat('CUST:', CAST(c_custkey AS STRING)) FROM customer
UNION ALL SELECT {_nation}, '{RDFS_SUBCLASS}', {_region.format("n_regionkey")} FROM nation
UNION ALL SELECT {_cust}, 'http://x.org/core#located in', {_nation.replace("n_nationkey", "c_nationkey")} FROM customer
UNION ALL SELECT {_nation}, '{OWL_DISJOINT}', 'http://x.org/obo/NAT_0' FROM nation
UNION ALL SELECT {_axiom}, '{RDF_TYPE}', '{OWL_AXIOM}' FROM supplier
UNION ALL SELECT {_axiom}, '{OWL_SOURCE}', {_nation.replace("n_nationkey", "s_nationkey")} FROM supplier
UNION ALL SELECT {_axiom}, '{OWL_TARGET}', CASE WHEN s_nationkey < 8 THEN {_region.format("0")} WHEN s_nationkey < 16 THEN 'http://x.org/untyped'
          ELSE concat('http://x.org/obo/CUST_', CAST(s_suppkey AS STRING)) END FROM supplier"""
VIEWS["ox_classes"] = f"SELECT DISTINCT s FROM fx_triples WHERE p = '{RDF_TYPE}' AND o = '{OWL_CLASS}'"
VIEWS["ox_metadata"] = f"""
SELECT c.s AS node_id, coalesce(l.o, 'None') AS label, coalesce(d.o, 'None') AS definition, coalesce(y.o, 'None') AS synonyms, coalesce(x.o, 'None') AS dbxrefs,
       CASE WHEN contains(split_part(c.s, '/', -1), '_') THEN upper(split_part(split_part(c.s, '/', -1), '_', 1)) ELSE split_part(c.s, '/', 3) END AS namespace
FROM ox_classes c LEFT JOIN (SELECT s, min(o) AS o FROM fx_triples WHERE p = '{RDFS_LABEL}' GROUP BY s) l ON l.s = c.s
LEFT JOIN (SELECT s, min(o) AS o FROM fx_triples WHERE p = '{OBO_DEFINITION}' GROUP BY s) d ON d.s = c.s
LEFT JOIN (SELECT s, string_agg(o, '|' ORDER BY o) AS o FROM (SELECT DISTINCT s, o FROM fx_triples WHERE p = '{OBO_SYNONYM}') GROUP BY s) y ON y.s = c.s
LEFT JOIN (SELECT s, string_agg(o, '|' ORDER BY o) AS o FROM (SELECT DISTINCT s, o FROM fx_triples WHERE p = '{OBO_DBXREF}') GROUP BY s) x ON x.s = c.s"""
VIEWS["ox_links"] = f"""
SELECT DISTINCT s, p, o FROM fx_triples WHERE p NOT IN ('{RDF_TYPE}', '{OWL_DISJOINT}') AND s IN (SELECT s FROM ox_classes) AND o IN (SELECT s FROM ox_classes)"""


def triple_table(inputs: Inputs) -> DataFrame:
    """The union as a stored table, which is what the jobs read."""
    return cut_lineage(inputs.view("fx_triples"))


@query("triples_metadata", "SELECT node_id, label, definition, namespace FROM ox_metadata")
def triples_metadata(inputs: Inputs) -> DataFrame:
    return triples.class_metadata(triple_table(inputs))


VIEWS["ox_class_values"] = f"""
SELECT s AS node_id, kind, row_number() OVER (PARTITION BY s, kind ORDER BY value) AS pos, value FROM (
  SELECT DISTINCT s, CASE p WHEN '{OBO_SYNONYM}' THEN 'synonym' ELSE 'dbxref' END AS kind, o AS value FROM fx_triples
  WHERE p IN ('{OBO_SYNONYM}', '{OBO_DBXREF}') AND s IN (SELECT s FROM ox_classes))"""


@query("triples_values", "SELECT * FROM ox_class_values")
def triples_values(inputs: Inputs) -> DataFrame:
    return triples.class_values(triple_table(inputs))


@query("triples_kept", f"""
WITH e AS (SELECT a.s, t.p, t.o, k.is_class FROM (SELECT DISTINCT s FROM fx_triples WHERE o = '{OWL_AXIOM}') a JOIN fx_triples t ON t.s = a.s AND t.p IN ('{OWL_SOURCE}', '{OWL_TARGET}')
  LEFT JOIN (SELECT s AS o, bool_or(o = '{OWL_CLASS}') AS is_class FROM fx_triples WHERE p = '{RDF_TYPE}' GROUP BY s) k ON k.o = t.o)
SELECT s AS entity, 'class' AS kind FROM ox_classes
UNION ALL SELECT s, 'axiom' FROM e GROUP BY s HAVING bool_or(coalesce(is_class, false)) AND NOT bool_or(is_class IS NOT NULL AND NOT is_class)
""")
def triples_kept(inputs: Inputs) -> DataFrame:
    return triples.kept_entities(triple_table(inputs))


@query("triples_edges", f"""
SELECT CASE WHEN contains(s, '_') THEN replace(split_part(s, '/', -1), '_', ':') ELSE split_part(s, '/', -1) END AS subject,
  CASE p WHEN '{RDFS_SUBCLASS}' THEN 'isa' ELSE 'located_in' END AS predicate, replace(split_part(o, '/', -1), '_', ':') AS object FROM ox_links
""")
def triples_edges(inputs: Inputs) -> DataFrame:
    return triples.triple_edges(triple_table(inputs), "X", *relation_tables(inputs))


# axioms with a property, restrictions, a list of all customers of a nation, and regions as unions of nations
_blank = lambda name, key: f"concat('_:{name}', CAST({key} AS STRING))"
_next = lambda name, key, group: f"coalesce(concat('_:{name}', CAST(lead({key}) OVER (PARTITION BY {group} ORDER BY {key}) AS STRING)), '{RDF_NIL}')"
VIEWS["fx_axiom_triples"] = f"""
SELECT s, p, o FROM fx_triples
UNION ALL SELECT {_axiom}, '{OWL_PROPERTY}', 'http://x.org/core#supplied from' FROM supplier
UNION ALL SELECT {_cust}, '{RDFS_SUBCLASS}', {_blank("r", "c_custkey")} FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')
UNION ALL SELECT {_blank("r", "c_custkey")}, '{OWL_ON_PROPERTY}', 'http://x.org/core#buys in' FROM customer
UNION ALL SELECT {_blank("r", "c_custkey")}, '{OWL_FILLERS[0]}', {_nation.replace("n_nationkey", "c_nationkey")} FROM customer
UNION ALL SELECT {_nation}, '{RDFS_SUBCLASS}', {_blank("i", "n_nationkey")} FROM nation
UNION ALL SELECT {_blank("i", "c_nationkey")}, '{OWL_INTERSECTION}', {_blank("c", "min(c_custkey)")} FROM customer GROUP BY c_nationkey
UNION ALL SELECT {_blank("c", "c_custkey")}, '{RDF_FIRST}', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {_blank("r", "c_custkey")} ELSE {_cust} END FROM customer
UNION ALL SELECT {_blank("c", "c_custkey")}, '{RDF_REST}', {_next("c", "c_custkey", "c_nationkey")} FROM customer
UNION ALL SELECT {_region.format("r_regionkey")}, '{OWL_EQUIVALENT}', {_blank("u", "r_regionkey")} FROM region
UNION ALL SELECT {_blank("u", "n_regionkey")}, '{OWL_UNION}', {_blank("n", "min(n_nationkey)")} FROM nation GROUP BY n_regionkey
UNION ALL SELECT {_blank("n", "n_nationkey")}, '{RDF_FIRST}', {_nation} FROM nation
UNION ALL SELECT {_blank("n", "n_nationkey")}, '{RDF_REST}', {_next("n", "n_nationkey", "n_regionkey")} FROM nation"""


@query("triples_axiom_edges", f"""
WITH k AS (SELECT s_nationkey, CASE WHEN s_nationkey < 8 THEN {_region.format("0")} ELSE 'http://x.org/untyped' END AS o FROM supplier WHERE s_nationkey < 16
  UNION ALL SELECT s_nationkey, concat('http://x.org/obo/CUST_', CAST(s_suppkey AS STRING)) FROM supplier
  WHERE s_nationkey >= 16 AND s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')),
links AS (
  SELECT s, p, o FROM ox_links
  UNION SELECT {_nation.replace("n_nationkey", "s_nationkey")}, 'http://x.org/core#supplied from', o FROM k
  UNION SELECT {_cust}, 'http://x.org/core#buys in', {_nation.replace("n_nationkey", "c_nationkey")} FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION SELECT {_nation.replace("n_nationkey", "c_nationkey")}, 'http://x.org/core#buys in', {_nation.replace("n_nationkey", "c_nationkey")} FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
  UNION SELECT {_nation.replace("n_nationkey", "c_nationkey")}, '{RDFS_SUBCLASS}', {_cust} FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')
  UNION SELECT {_nation}, '{RDFS_SUBCLASS}', {_region.format("n_regionkey")} FROM nation)
SELECT replace(split_part(s, '/', -1), '_', ':') AS subject, CASE WHEN p = '{RDFS_SUBCLASS}' THEN 'isa' ELSE replace(split_part(p, '#', -1), ' ', '_') END AS predicate,
  replace(split_part(o, '/', -1), '_', ':') AS object FROM links
""")
def triples_axiom_edges(inputs: Inputs) -> DataFrame:
    return triples.triple_edges(cut_lineage(inputs.view("fx_axiom_triples")), "X", *relation_tables(inputs))


@query("nodes_in_edges", "SELECT node_id, label FROM ox_metadata WHERE node_id IN (SELECT s FROM ox_links UNION SELECT o FROM ox_links)")
def nodes_in_edges(inputs: Inputs) -> DataFrame:
    table = triple_table(inputs)
    return triples.nodes_in_links(triples.class_metadata(table), triples.class_links(table)).select("node_id", "label")


@query("triples_nodes", """
SELECT replace(split_part(node_id, '/', -1), '_', ':') AS node_id, CASE label WHEN 'None' THEN replace(split_part(node_id, '/', -1), '_', ':') ELSE label END AS node_label,
  nullif(definition, 'None') AS node_definition
FROM ox_metadata WHERE node_id IN (SELECT s FROM ox_links UNION SELECT o FROM ox_links)
""")
def triples_nodes(inputs: Inputs) -> DataFrame:
    return triples.triple_nodes(triple_table(inputs), "X")


@query("triples_node_values", """
SELECT replace(split_part(node_id, '/', -1), '_', ':') AS node_id, kind, pos, value
FROM ox_class_values WHERE node_id IN (SELECT s FROM ox_links UNION SELECT o FROM ox_links)
""")
def triples_node_values(inputs: Inputs) -> DataFrame:
    return triples.triple_node_values(triple_table(inputs), "X")


@query("triple_stats", """
SELECT 'nodes' AS metric, count(*) AS n FROM (SELECT s FROM fx_triples UNION SELECT o FROM fx_triples)
UNION ALL SELECT 'triples', count(*) FROM fx_triples UNION ALL SELECT 'predicates', count(DISTINCT p) FROM fx_triples
""")
def triple_stats(inputs: Inputs) -> DataFrame:
    return triples.triple_stats(triple_table(inputs))


@query("pipe_agg", "SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS pos, p_name FROM (SELECT DISTINCT p_brand, p_name FROM part)")
def pipe_agg(inputs: Inputs) -> DataFrame:
    return list_rows(inputs.table("part").select("p_brand", "p_name").distinct(), "p_brand", "p_name", ["p_name"])


# ---- one-shot converter ------------------------------------------------------------------

VIEWS["fx_iri_nodes"] = """
SELECT concat('http://x.org/obo/PART_', CAST(p_partkey AS STRING)) AS node_id, CASE p_type WHEN 'PROMO' THEN 'None' ELSE p_name END AS node_label,
       CASE p_type WHEN 'SMALL' THEN 'nan' WHEN 'LARGE' THEN NULL ELSE concat('a ', p_brand) END AS node_definition,
       CASE p_type WHEN 'ECONOMY' THEN 'None' ELSE concat(p_brand, '|', p_name) END AS node_synonyms,
       CASE p_type WHEN 'MEDIUM' THEN NULL ELSE concat('UMLS:C', CAST(p_size AS STRING), '|FMA:', CAST(p_partkey AS STRING)) END AS node_dbxrefs,
       CAST(p_size AS STRING) AS value, 'None' AS lowerbound, 'nan' AS unit FROM part"""
VIEWS["ox_iri_nodes"] = """
SELECT replace(split_part(node_id, '/', -1), '_', ':') AS id, CASE node_label WHEN 'None' THEN '' ELSE node_label END AS label,
       CASE WHEN node_definition IS NULL OR node_definition = 'nan' THEN '' ELSE node_definition END AS def,
       CASE WHEN node_synonyms = 'None' THEN [] ELSE string_split(node_synonyms, '|') END AS syns,
       CASE WHEN node_dbxrefs IS NULL THEN [] ELSE string_split(node_dbxrefs, '|') END AS xrefs, CAST(value AS DOUBLE) AS value FROM fx_iri_nodes"""


@query("oneshot_nodes", """
SELECT 'Concept' AS kind, id, label AS pref_term, '' AS def, 'PART' AS sab FROM ox_iri_nodes
UNION ALL SELECT 'Term', label, '', '', 'PART' FROM ox_iri_nodes
UNION ALL SELECT 'Term', s, '', '', 'PART' FROM (SELECT label, unnest(syns) AS s FROM ox_iri_nodes) WHERE s <> label
UNION ALL SELECT 'Label_Definition', id, '', def, 'PART' FROM ox_iri_nodes WHERE def <> ''
UNION ALL SELECT 'Concept', x, x, '', split_part(x, ':', 1) FROM (SELECT unnest(xrefs) AS x FROM ox_iri_nodes)
""")
def oneshot_nodes(inputs: Inputs) -> DataFrame:
    return oneshot.oneshot_nodes(inputs.view("fx_iri_nodes"))


VIEWS["fx_iri_edges"] = f"""
SELECT concat('http://x.org/obo/ORD_', CAST(l_orderkey AS STRING)) AS subject, CASE l_linestatus WHEN 'O' THEN '{RDFS_SUBCLASS}'
       ELSE concat('http://purl.obolibrary.org/obo/RO_', lpad(CAST(l_partkey AS STRING), 7, '0')) END AS predicate,
       concat('http://x.org/obo/PART_', CAST(l_partkey AS STRING)) AS object, CASE l_returnflag WHEN 'A' THEN 'None' ELSE l_returnflag END AS evidence_class FROM lineitem"""


@query("oneshot_rels", f"""
SELECT CASE e.predicate WHEN '{RDFS_SUBCLASS}' THEN 'ISA' ELSE coalesce(n.lbl, split_part(e.predicate, '_', -1)) END AS label,
  replace(split_part(subject, '/', -1), '_', ':') AS start_id, replace(split_part(object, '/', -1), '_', ':') AS end_id,
  CASE evidence_class WHEN 'None' THEN '' ELSE evidence_class END AS evidence_class FROM fx_iri_edges e LEFT JOIN fx_relation_nodes n ON n.id = e.predicate
""")
def oneshot_rels(inputs: Inputs) -> DataFrame:
    return oneshot.oneshot_rels(inputs.view("fx_iri_edges"), inputs.view("fx_relation_nodes"))


@query("oneshot_code_rels", """
SELECT id AS start_id, CASE WHEN label = '' THEN 'None' ELSE label END AS end_id, 'PT' AS tty, def, CAST(0 AS DOUBLE) AS lowerbound, value, '' AS unit, id AS codeid, 'X' AS sab FROM ox_iri_nodes
UNION ALL SELECT id, unnest(syns), 'SYN', NULL, NULL, NULL, NULL, id, 'X' FROM ox_iri_nodes
""")
def oneshot_code_rels(inputs: Inputs) -> DataFrame:
    return oneshot.oneshot_code_rels(inputs.view("fx_iri_nodes"), "X").drop("upperbound")


@query("source_discovery", """
SELECT concat(sab, ':', sab) AS id, sab AS name, sab FROM (SELECT 'PART' AS sab FROM part UNION SELECT split_part(x, ':', 1) FROM (SELECT unnest(xrefs) AS x FROM ox_iri_nodes))
""")
def source_discovery(inputs: Inputs) -> DataFrame:
    return oneshot.source_discovery(inputs.view("fx_iri_nodes"))


@query("relation_definitions", f"""
SELECT 'X:ISA' AS id, 'Subject is a class of object.' AS def, 'ISA' AS label, 'X' AS sab UNION ALL SELECT 'X:CODE', 'Subject has CODE relationship with object', 'CODE', 'X'
UNION ALL SELECT CASE WHEN n.lbl IS NULL THEN p.predicate ELSE replace(p.predicate, '_', ':') END, coalesce(n.def, ''), coalesce(n.lbl, p.predicate), 'X'
FROM (SELECT DISTINCT predicate FROM fx_iri_edges WHERE predicate <> '{RDFS_SUBCLASS}') p LEFT JOIN fx_relation_nodes n ON n.id = p.predicate
""")
def relation_definitions(inputs: Inputs) -> DataFrame:
    return oneshot.relation_definitions(inputs.view("fx_iri_edges"), inputs.view("fx_relation_nodes"), "X")


# ---- field vocabulary --------------------------------------------------------------------

VIEWS["fx_field"] = "SELECT concat('field', CAST(c_custkey AS STRING)) AS field, c_name AS value, c_custkey AS ord FROM customer"
VIEWS["fx_field_type"] = """
SELECT concat('field', CAST(c_custkey AS STRING)) AS field, CASE c_mktsegment WHEN 'BUILDING' THEN 'number' WHEN 'MACHINERY' THEN 'datetime' WHEN 'HOUSEHOLD' THEN 'string' ELSE 'other' END AS value, c_custkey AS ord FROM customer"""
VIEWS["fx_field_entity"] = """
SELECT concat('field', CAST(c_custkey AS STRING)) AS field, concat('["', lower(c_mktsegment), '","n', CAST(c_nationkey AS STRING), '"]') AS value, c_custkey AS ord FROM customer"""
VIEWS["fx_field_assay"] = """
SELECT concat('field', CAST(c_custkey AS STRING)) AS field, concat('["assay', CAST(c_nationkey AS STRING), '"]') AS value, c_custkey AS ord FROM customer"""
VIEWS["fx_field_schema"] = """
SELECT concat('field', CAST(c_custkey AS STRING)) AS field, concat('schema', CAST(c_nationkey AS STRING)) AS value, c_custkey AS ord FROM customer"""
VIEWS["fx_vocabulary_links"] = """
SELECT concat('CEDAR:', CAST(c_custkey AS STRING)) AS codeid, concat('CEDAR:', CAST(c_custkey AS STRING)) AS start_id, concat('field', CAST(c_nationkey AS STRING)) AS end_id, 'PT' AS tty FROM customer
UNION ALL SELECT concat('HUBMAP:', CAST(n_nationkey AS STRING)), concat('HUBMAP:', CAST(n_nationkey AS STRING)), CASE WHEN n_nationkey > 12 THEN concat('assay', CAST(n_nationkey AS STRING)) ELSE concat('N', CAST(n_nationkey AS STRING)) END, 'PT' FROM nation
UNION ALL SELECT 'XSD:string', 'XSD:string', 'string', 'PT' FROM region"""
VIEWS["fx_vocabulary_rels"] = "SELECT 'isa' AS label, 'XSD:string' AS start_id, 'XSD:anySimpleType' AS end_id, 'CEDAR' AS sab FROM region"
VIEWS["fx_assays"] = "SELECT concat('assay', CAST(n_nationkey AS STRING)) AS term FROM nation"

#: Numbers of the parents with room for every field of the largest table.
FIELD_PARENTS = {"sab": 0, "field": 100_000_000, "type": 200_000_000, "entity": 300_000_000, "assay": 400_000_000, "schema": 500_000_000}
_kinds = {kind: number for kind, number in FIELD_PARENTS.items() if kind != "sab"}
VIEWS["ox_field_values"] = " UNION ALL ".join(
    ["SELECT 'field' AS kind, field, field AS value, ord, CAST(0 AS BIGINT) AS pos FROM fx_field"]
    + [f"SELECT '{k}', field, value, ord, 0 FROM fx_field_{k}" for k in ("type", "schema")]
    + [f"SELECT '{k}', field, unnest(l), ord, generate_subscripts(l, 1) FROM (SELECT field, ord, from_json(value, '[\"VARCHAR\"]') AS l FROM fx_field_{k})" for k in ("entity", "assay")]
)
_offset = "CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in _kinds.items()) + " END"
VIEWS["ox_field_ids"] = f"""
SELECT kind, label, concat('HM:', CAST({_offset} + row_number() OVER (PARTITION BY kind ORDER BY ord, pos, label) AS STRING)) AS node_id FROM
  (SELECT kind, label, (m).ord AS ord, (m).pos AS pos FROM (SELECT kind, value AS label, min({{'ord': ord, 'pos': pos}}) AS m FROM ox_field_values GROUP BY kind, value))"""


def field_tables(inputs: Inputs) -> dict[str, DataFrame]:
    return {"field": inputs.view("fx_field"), **{k: inputs.view(f"fx_field_{k}") for k in ("type", "entity", "assay", "schema")}}


def field_vocabulary_tables(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    return field_vocabulary.vocabulary(
        field_tables(inputs), "HM", inputs.view("fx_vocabulary_rels"), inputs.view("fx_vocabulary_links"), inputs.view("fx_assays"), FIELD_PARENTS
    )


VIEWS["ox_associations"] = """
SELECT f.node_id AS subject, CASE v.kind WHEN 'type' THEN 'has_datatype' WHEN 'entity' THEN 'used_in_entity' WHEN 'assay' THEN 'used_in_dataset' ELSE 'used_in_schema' END AS predicate, o.node_id AS object
FROM ox_field_values v JOIN ox_field_ids f ON f.kind = 'field' AND f.label = v.field JOIN ox_field_ids o ON o.kind = v.kind AND o.label = v.value WHERE v.kind <> 'field'"""


@query("association_edges", "SELECT * FROM ox_associations WHERE predicate = 'used_in_entity'")
def association_edges(inputs: Inputs) -> DataFrame:
    tables = field_tables(inputs)
    fields, entities = (field_vocabulary.encode_values(tables[k], k, "HM", FIELD_PARENTS) for k in ("field", "entity"))
    return field_vocabulary.association_edges(tables["entity"], fields, entities, "used_in_entity")


@query("vocabulary_edges", f"""
SELECT node_id AS subject, 'isa' AS predicate, concat('HM:', CAST({_offset} AS STRING)) AS object FROM ox_field_ids UNION ALL SELECT * FROM ox_associations
""")
def vocabulary_edges(inputs: Inputs) -> DataFrame:
    return field_vocabulary_tables(inputs)[0]


@query("vocabulary_nodes", f"""
SELECT i.node_id, i.label AS node_label, CASE i.kind WHEN 'field' THEN f.value ELSE concat('HM ', i.label, ' ', i.kind) END AS node_definition,
  CASE i.kind WHEN 'type' THEN CASE i.label WHEN 'number' THEN 'XSD:float' WHEN 'datetime' THEN 'XSD:dateTime' WHEN 'string' THEN 'XSD:string' ELSE '' END
    WHEN 'schema' THEN '' ELSE coalesce(x.code, '') END AS node_dbxrefs
FROM ox_field_ids i LEFT JOIN fx_field f ON i.kind = 'field' AND f.field = i.label
LEFT JOIN (SELECT end_id AS term, split_part(codeid, ':', 1) AS sab, min(codeid) AS code FROM fx_vocabulary_links GROUP BY 1, 2) x
  ON x.term = CASE i.kind WHEN 'entity' THEN concat(upper(substr(i.label, 1, 1)), lower(substr(i.label, 2))) ELSE i.label END
  AND x.sab = CASE i.kind WHEN 'field' THEN 'CEDAR' ELSE 'HUBMAP' END
UNION ALL SELECT * FROM (VALUES {', '.join(f"('HM:{number:04d}', 'HM {kind} parent node', '', '')" for kind, number in FIELD_PARENTS.items())}) v
""")
def vocabulary_nodes(inputs: Inputs) -> DataFrame:
    return field_vocabulary_tables(inputs)[1].drop("node_synonyms")


@query("typed_xref", """
SELECT DISTINCT value AS label, CASE value WHEN 'number' THEN 'XSD:float' WHEN 'datetime' THEN 'XSD:dateTime' WHEN 'string' THEN 'XSD:string' ELSE '' END AS node_dbxrefs FROM fx_field_type
""")
def typed_xref(inputs: Inputs) -> DataFrame:
    types = field_vocabulary.datatype_codes(inputs.view("fx_vocabulary_rels"), inputs.view("fx_vocabulary_links"))
    return field_vocabulary.type_xref(inputs.view("fx_field_type").select(F.col("value").alias("label")).distinct(), types)
