"""Queries over scalar functions and single-table steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.functions import codes, text
from vocabweave.functions.fixed_values import PREFIX_SOURCES, RELATION_LABELS
from vocabweave.operators.affixes import affix_join, standardize_codes
from vocabweave.operators.relations import format_relation, label_of_suffix
from vocabweave.operators.rows import dedupe_counts
from vocabweave.plans.catalog import VIEWS, Inputs, query
from vocabweave.sources import annotations, oneshot, tables, triples

# raw spellings of codes, one form per remainder of the part key
SPELLINGS = [
    ("X", "concat('http://ncicb.nci.nih.gov/xml/owl/EVS/Thesaurus.owl#C', k)"),
    ("X", "concat('EDAM:format_', k)"),
    ("X", "concat('http://edamontology.org/data_', k)"),
    ("X", "concat('http://identifiers.org/hgnc/', k)"),
    ("X", "concat('http://purl.obolibrary.org/obo/mondo#ordo_', p_name)"),
    ("X", "concat('REFSEQ NR ', k)"),
    ("X", "concat('MSIGDB ', p_name, ' ', k)"),
    ("X", "concat('REACTOME_VS:C', k)"),
    ("X", "concat('https://repo.metadatacenter.org/templates/', k)"),
    ("X", "concat('https://repo.metadatacenter.org/template-fields/', k)"),
    ("X", "concat('https://schema.metadatacenter.org/core/T', k)"),
    ("X", "concat('http://www.w3.org/2001/XMLSchema#t', k)"),
    ("X", "concat('https://purl.humanatlas.io/vocab/hravs#HRAVS_', k)"),
    ("X", "concat('hravs HRAVS ', k)"),
    ("X", "concat('http://dicom.nema.org/resources/ontology/DCM/', k)"),
    ("X", "concat('http://purl.bioontology.org/ontology/LNC/LP', k)"),
    ("X", "concat('http://www.orpha.net/ORDO/Orphanet_', k)"),
    ("GLYCOCOO", "concat('http://purl.jp/bio/12/glyco/conjugate#', p_name, '/', k)"),
    ("NPO", "concat('http://www.pantherdb.org/panther/family.do?clsAccession=PTHR', k)"),
    ("NPOSKCAN", "concat('http://uri.neuinfo.org/nif/nifstd/nlx_cell_', k)"),
    ("X", "concat('http://uri.neuinfo.org/nif/nifstd/nlx_cell_', k)"),
    ("X", "concat('http://purl.uniprot.org/uniprot/', k)"),
    ("X", "concat('HGNC HGNC:', k)"),
    ("X", "concat('HPO HP:', k)"),
    ("X", "concat('HCOP HCOP:', k)"),
    ("X", "concat('NCBI Gene', k)"),
    ("X", "concat('GENCODE_VS:C', k)"),
    ("X", "concat('SENOTYPE_VS:C', k)"),
    ("X", "concat('http://purl.obolibrary.org/obo/UBERON_', k)"),
    ("X", "concat('ncit:c', k)"),
    ("X", "concat('NCIT:C', k)"),
    ("X", "concat('MESH_D', k)"),
    ("X", "concat('http://purl.obolibrary.org/obo/NCBITaxon_', k)"),
    ("X", "concat('UMLS_CUI:C', k)"),
    ("X", "concat('SNOMEDCT_US_2020:', k)"),
    ("X", "concat('fma', k)"),
    ("X", "concat('fma:', k)"),
    ("X", "concat('http://purl.org/Hugo.owl#HGNC_', k)"),
    ("X", "concat('C', k)"),
    ("X", "concat('CURATED', k)"),
    ("X", "concat('part:', p_brand, ' ', p_name)"),
    ("X", "concat('http://purl.obolibrary.org/obo/', p_brand, ' ', p_type)"),
]
_n = len(SPELLINGS)
VIEWS["fx_raw_codes"] = (
    f"SELECT p_partkey, CASE p_partkey % {_n} "
    + " ".join(f"WHEN {i} THEN {expr}" for i, (_, expr) in enumerate(SPELLINGS))
    + f" END AS raw, CASE p_partkey % {_n} "
    + " ".join(f"WHEN {i} THEN '{sab}'" for i, (sab, _) in enumerate(SPELLINGS) if sab != "X")
    + " ELSE 'X' END AS sab FROM (SELECT *, CAST(p_partkey AS STRING) AS k FROM part) p"
)


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(rows))


@query("code_standardize", f"""
WITH prefixes AS (SELECT * FROM (VALUES {_values(PREFIX_SOURCES)}) v(n, prefix, source)),
m AS (SELECT p_partkey, arg_max(source, n) AS mapped FROM fx_raw_codes JOIN prefixes ON contains(raw, prefix) GROUP BY p_partkey),
a AS (SELECT c.*, mapped, split_part(translate(raw, ':#_', '   '), '/', -1) AS b0 FROM fx_raw_codes c LEFT JOIN m USING (p_partkey)),
b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(b0, 'NCIT ', 'NCI:'), 'MESH ', 'MSH:'),
      'NCBITaxon ', 'NCBI:'), '.*UMLS.*\\s', 'UMLS:'), '.*SNOMED.*\\s', 'SNOMEDCT_US:'), '^fma ?', 'FMA:') AS b1 FROM a),
c AS (SELECT p_partkey, raw, sab, CASE
  WHEN contains(raw, 'SENOTYPE_VS') THEN replace(raw, 'SENOTYPE:VS', 'SENOTYPE_VS')
  WHEN contains(raw, 'GENCODE_VS') THEN replace(raw, 'GENCODE:VS', 'GENCODE_VS')
  WHEN contains(raw, 'NCBI Gene') THEN replace(raw, 'NCBI Gene', 'ENTREZ:')
  WHEN contains(raw, 'HCOP HCOP:') THEN replace(raw, 'HCOP HCOP:', 'HCOP:')
  WHEN contains(raw, 'HPO HP:') THEN replace(raw, 'HPO HP:', 'HP:')
  WHEN contains(raw, 'HGNC HGNC:') THEN replace(raw, 'HGNC HGNC:', 'HGNC:')
  WHEN contains(raw, 'uniprot.org') THEN concat('UNIPROT:', split_part(raw, '/', -1))
  WHEN sab IN ('NPO', 'NPOSKCAN') AND mapped IS NOT NULL THEN concat(mapped, ':', split_part(translate(raw, ' /=', '___'), '_', -1))
  WHEN sab IN ('GLYCOCOO', 'GLYCORDF') AND mapped IS NOT NULL THEN concat(mapped, ':', split_part(translate(raw, ' /', '__'), '#', -1))
  WHEN contains(raw, 'http://www.orpha.net/ORDO/') THEN concat('ORDO:', split_part(raw, '_', -1))
  WHEN contains(raw, 'http://purl.bioontology.org/ontology/LNC') THEN concat('LNC:', split_part(raw, '/', -1))
  WHEN contains(raw, 'http://dicom.nema.org/resources/ontology/DCM/') THEN concat('DCM:', split_part(raw, '/', -1))
  WHEN contains(upper(raw), 'HRAVS HRAVS') THEN concat('HRAVS:', split_part(raw, ' ', -1))
  WHEN contains(raw, 'https://purl.humanatlas.io/vocab/hravs#') THEN concat('HRAVS:', split_part(raw, '_', -1))
  WHEN contains(raw, 'http://www.w3.org/2001/XMLSchema') THEN concat('XSD:', split_part(raw, '#', -1))
  WHEN contains(raw, 'https://schema.metadatacenter.org/core/') OR contains(raw, 'https://repo.metadatacenter.org/template-fields/')
    OR contains(raw, 'https://repo.metadatacenter.org/templates/') THEN concat('CEDAR:', split_part(raw, '/', -1))
  WHEN contains(raw, 'REACTOME') THEN replace(replace(raw, 'REACTOME ', 'REACTOME:'), ' ', '_')
  WHEN contains(raw, 'MSIGDB') THEN replace(replace(raw, 'MSIGDB ', 'MSIGDB:'), ' ', '_')
  WHEN contains(raw, 'REFSEQ') THEN replace(replace(raw, 'REFSEQ ', 'REFSEQ:'), ' ', '_')
  WHEN contains(raw, 'http://purl.obolibrary.org/obo/mondo#') THEN concat('MONDO:', split_part(raw, '#', -1))
  WHEN contains(raw, 'http://identifiers.org/hgnc') THEN concat('HGNC:', split_part(raw, '/', -1))
  WHEN contains(raw, 'edam') THEN concat('EDAM:', split_part(replace(raw, ' ', '_'), '/', -1))
  WHEN contains(raw, 'EDAM') THEN concat('EDAM:', split_part(raw, ':', -1))
  WHEN contains(raw, 'Thesaurus.owl') THEN concat('NCI:', split_part(raw, '#', -1))
  ELSE replace(replace(b1, 'Hugo.owl HGNC ', 'HGNC:'), 'gene symbol report?hgnc id=', 'HGNC:') END AS v FROM b)
SELECT p_partkey, raw, sab, CASE WHEN contains(v, ' ') THEN concat(upper(split_part(v, ' ', 1)), ':', substr(v, strpos(v, ' ') + 1))
  WHEN regexp_matches(v, '^C[0-9]') AND NOT contains(v, 'CEDAR') THEN concat('UMLS:', v) ELSE v END AS code FROM c
""")
def code_standardize(inputs: Inputs) -> DataFrame:
    raw = inputs.view("fx_raw_codes")
    return raw.withColumn("code", codes.standardize_code(F.col("raw"), F.col("sab")))


@query("prefix_map", f"""
WITH prefixes AS (SELECT * FROM (VALUES {_values(PREFIX_SOURCES)}) v(n, prefix, source)),
m AS (SELECT p_partkey, arg_max(source, n) AS source FROM fx_raw_codes JOIN prefixes ON contains(raw, prefix) GROUP BY p_partkey)
SELECT p_partkey, raw, source FROM fx_raw_codes LEFT JOIN m USING (p_partkey)
""")
def prefix_map(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_raw_codes").select("p_partkey", "raw", codes.prefix_source(F.col("raw")).alias("source"))


VIEWS["fx_suffix_labels"] = """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN concat(p_name, '_OBI_0000299') WHEN 'SMALL' THEN ' efo_0000784 '
  WHEN 'LARGE' THEN concat('Orphanet_C0', CAST(p_size AS STRING)) ELSE p_name END AS label FROM part"""


@query("suffix_map", f"""
WITH m AS (SELECT * FROM (VALUES {_values(RELATION_LABELS)}) v(n, code, name)),
hit AS (SELECT p_partkey, arg_min(name, n) AS relation FROM fx_suffix_labels JOIN m ON suffix(lower(trim(label)), lower(code)) GROUP BY p_partkey)
SELECT p_partkey, label, relation FROM fx_suffix_labels LEFT JOIN hit USING (p_partkey)
""")
def suffix_map(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_suffix_labels").withColumn("relation", label_of_suffix(F.col("label")))


# maps that are tables: codes of customers by the end of a label, suppliers by their name in a text
VIEWS["fx_label_map"] = """
SELECT c_name AS key, c_mktsegment AS value, c_custkey AS ord FROM customer
UNION ALL SELECT substr(c_name, length(c_name) - 2, 3), concat('any ', c_mktsegment), 1000000000 - c_custkey FROM customer
UNION ALL SELECT '', 'never', 0 FROM region"""
VIEWS["fx_order_labels"] = """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN concat('order of CUSTOMER#', lpad(CAST(o_custkey AS STRING), 9, '0'))
  WHEN '2-HIGH' THEN concat('number ', CAST(o_custkey AS STRING)) ELSE o_orderpriority END AS label FROM orders"""


@query("suffix_map_table", """
WITH hit AS (SELECT label, arg_min(value, ord) AS relation FROM (SELECT DISTINCT label FROM fx_order_labels) JOIN fx_label_map ON key <> '' AND suffix(lower(label), lower(key)) GROUP BY label)
SELECT o_orderkey, label, relation FROM fx_order_labels LEFT JOIN hit USING (label)
""")
def suffix_map_table(inputs: Inputs) -> DataFrame:
    keys = inputs.view("fx_label_map").withColumn("key", F.lower("key"))
    labels = inputs.view("fx_order_labels").withColumn("folded", F.lower("label"))
    return affix_join(labels, "folded", keys, "relation").drop("folded")


VIEWS["fx_source_map"] = """
SELECT concat(s_name, '_') AS key, concat('SUPP', CAST(s_nationkey AS STRING)) AS value, s_suppkey AS ord FROM supplier
UNION ALL SELECT c_mktsegment, c_mktsegment, 100000000 + min(c_custkey) FROM customer WHERE c_mktsegment LIKE 'B%' GROUP BY c_mktsegment"""
VIEWS["fx_mixed_codes"] = """
SELECT DISTINCT concat('http://x.org/Supplier#', lpad(CAST(l_suppkey AS STRING), 9, '0'), CASE WHEN l_linenumber < 4 THEN '_' ELSE '/' END,
  CASE l_linestatus WHEN 'O' THEN 'BUILDING_' ELSE 'none_' END, 'id=', CAST(l_linenumber AS STRING)) AS raw FROM lineitem"""


@query("prefix_map_table", """
WITH hit AS (SELECT raw, arg_max(value, ord) AS source FROM fx_mixed_codes JOIN fx_source_map ON contains(raw, key) GROUP BY raw)
SELECT raw, source, CASE WHEN source IS NOT NULL THEN concat(source, ':', list_last(string_split(translate(raw, ' /=', '___'), '_'))) END AS code
FROM fx_mixed_codes LEFT JOIN hit USING (raw)
""")
def prefix_map_table(inputs: Inputs) -> DataFrame:
    prefixes = inputs.view("fx_source_map")
    found = affix_join(inputs.view("fx_mixed_codes"), "raw", prefixes, "source", "inside", last=True)
    spelled = standardize_codes(found, "raw", "NPO", prefixes)
    return spelled.select("raw", "source", F.when(F.col("source").isNotNull(), F.col("code")).alias("code"))


@query("synonym_standardize", "SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9._ ]', '_', 'g') AS synonym FROM documents")
def synonym_standardize(inputs: Inputs) -> DataFrame:
    rows = inputs.table("documents").select("doc_id", F.array("text").alias("synonyms"))
    return rows.select("doc_id", F.explode(text.standardize_synonyms(F.col("synonyms"))).alias("synonym"))


VIEWS["fx_labels"] = """
SELECT url AS label FROM pages
UNION ALL SELECT concat(CAST(p_size AS STRING), 'd-', p_name, ' (', p_type, ').[', p_brand, ']') FROM part
UNION ALL SELECT concat(s_name, ':{', CAST(s_nationkey AS STRING), '}') FROM supplier"""


@query("relation_format", r"""
WITH t AS (SELECT label, lower(translate(label, '.-()[]{}: ', '__________')) AS x FROM fx_labels)
SELECT label, CASE WHEN regexp_matches(x, '^\pN') THEN concat('rel_', x) ELSE x END AS relation FROM t
""")
def relation_format(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_labels").withColumn("relation", format_relation(F.col("label")))


@query("iri_to_curie", "SELECT page_id, replace(split_part(url, '/', -1), '_', ':') AS curie FROM pages")
def iri_to_curie(inputs: Inputs) -> DataFrame:
    return inputs.table("pages").select("page_id", codes.iri_to_curie(F.col("url")).alias("curie"))


@query("iri_namespace", r"""
SELECT raw, CASE WHEN contains(split_part(raw, '/', -1), '_') THEN upper(regexp_extract(split_part(raw, '/', -1), '^(.*?)(\W|_)', 1))
  ELSE nullif(split_part(raw, '/', 3), '') END AS namespace
FROM (SELECT url AS raw FROM pages UNION ALL SELECT raw FROM fx_raw_codes WHERE raw LIKE 'http%')
""")
def iri_namespace(inputs: Inputs) -> DataFrame:
    iris = inputs.sql("SELECT url AS raw FROM pages UNION ALL SELECT raw FROM fx_raw_codes WHERE raw LIKE 'http%'")
    return iris.withColumn("namespace", F.nullif(codes.iri_namespace(F.col("raw")), F.lit("")))


@query("sab_of_code", "SELECT node_id, dbxref, split_part(dbxref, ':', 1) AS sab FROM fx_xrefs")
def sab_of_code(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_xrefs").select("node_id", "dbxref", codes.sab_of_code(F.col("dbxref")).alias("sab"))


VIEWS["fx_null_like"] = """
SELECT event_id, CASE event_type WHEN 'click' THEN 'None' WHEN 'view' THEN 'nan' WHEN 'error' THEN NULL ELSE event_type END AS value FROM events"""


@query("null_like", "SELECT event_id, value, CASE WHEN value IS NULL OR value IN ('None', 'nan') THEN '' ELSE value END AS cleaned FROM fx_null_like")
def null_like(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_null_like").withColumn("cleaned", text.blank_if_null_like(F.col("value")))


@query("pipe_split", """
SELECT node_id, CAST(len(string_split(node_synonyms, '|')) AS BIGINT) AS n_items, split_part(node_synonyms, '|', 1) AS first_item,
  split_part(node_synonyms, '|', -1) AS last_item FROM fx_nodes
""")
def pipe_split(inputs: Inputs) -> DataFrame:
    items = text.pipe_split(F.col("node_synonyms"))
    return inputs.view("fx_nodes").select(
        "node_id", F.size(items).cast("bigint").alias("n_items"), F.element_at(items, 1).alias("first_item"),
        F.element_at(items, -1).alias("last_item"),
    )


@query("explode_lists", """
SELECT node_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS item
FROM (SELECT node_id, string_split(node_synonyms, '|') AS l FROM fx_nodes)
""")
def explode_lists(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_nodes").select("node_id", F.posexplode(text.pipe_split(F.col("node_synonyms"))).alias("pos", "item"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


VIEWS["fx_srl"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat(CAST(o_custkey AS STRING), '.0') END AS srl FROM orders"""


@query("blank_to_int", "SELECT o_orderkey, CAST(CAST(nullif(srl, '') AS DOUBLE) AS INTEGER) AS srl FROM fx_srl")
def blank_to_int(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_srl").withColumn("srl", text.blank_to_int(F.col("srl")))


VIEWS["fx_list_cells"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN concat('[''', o_orderpriority, ''', ''', CAST(o_custkey AS STRING), ''']')
  ELSE 'no list' END AS cell FROM orders"""


@query("parse_list_cell", """
SELECT o_orderkey, array_to_string(regexp_extract_all(cell, '''([^'']*)''', 1), '|') AS items FROM fx_list_cells
""")
def parse_list_cell(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_list_cells").select("o_orderkey", F.array_join(text.parse_list_cell(F.col("cell")), "|").alias("items"))


VIEWS["fx_accessions"] = """
SELECT concat('ENSG', lpad(CAST(l_orderkey AS STRING), 11, '0'), '.', CAST(l_linenumber AS STRING)) AS accession FROM lineitem"""


@query("strip_version", "SELECT accession, split_part(accession, '.', 1) AS stripped, split_part(accession, '.', 2) AS version FROM fx_accessions")
def strip_version(inputs: Inputs) -> DataFrame:
    accession = F.col("accession")
    return inputs.view("fx_accessions").select(
        "accession", codes.strip_version(accession).alias("stripped"), codes.version_of(accession).alias("version")
    )


VIEWS["fx_bracket_cells"] = """
SELECT p_partkey, concat(p_type, ' process [P:', CAST(p_partkey AS STRING), ']; ', p_name, ' [', p_brand, '] thing [S:',
  CAST(p_size AS STRING), ']; ', p_brand) AS cell FROM part"""


@query("bracket_ids", """
SELECT p_partkey, unnest(list_transform(list_filter(string_split(cell, ';'), lambda x: contains(x, '[')),
  lambda x: split_part(split_part(x, '[', -1), ']', 1))) AS term FROM fx_bracket_cells
""")
def bracket_ids(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_bracket_cells").select("p_partkey", F.explode(text.bracket_ids(F.col("cell"))).alias("term"))


VIEWS["fx_names"] = """
SELECT p_partkey, p_brand AS entry_name, concat(p_name, ' (', p_brand, ') (', p_type, '(', CAST(p_size AS STRING), '))') AS names FROM part"""


@query("paren_groups", """
SELECT p_partkey, CAST(0 AS BIGINT) AS level, p_brand AS content FROM part
UNION ALL SELECT p_partkey, 1, CAST(p_size AS STRING) FROM part
UNION ALL SELECT p_partkey, 0, concat(p_type, '(', CAST(p_size AS STRING), ')') FROM part
""")
def paren_groups(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_names").select("p_partkey", F.explode(text.parenthesis_groups(F.col("names"))).alias("g"))
    return rows.select("p_partkey", F.col("g.level").cast("bigint").alias("level"), "g.content")


@query("names_and_synonyms", """
SELECT p_partkey, p_name AS name, concat(p_brand, '|', p_brand, '|', p_type, '(', CAST(p_size AS STRING), ')') AS synonyms FROM part
""")
def names_and_synonyms(inputs: Inputs) -> DataFrame:
    names = F.col("names")
    return inputs.view("fx_names").select(
        "p_partkey", text.recommended_name(names).alias("name"),
        F.array_join(F.concat(F.array("entry_name"), text.outer_groups(names)), "|").alias("synonyms"),
    )


VIEWS["fx_marked"] = """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN concat(p_name, '_vitessce_hint_', p_brand) ELSE p_name END AS label FROM part"""


@query("strip_marker", "SELECT p_partkey, split_part(label, '_vitessce_hint', 1) AS label FROM fx_marked")
def strip_marker(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_marked").select("p_partkey", text.strip_marker(F.col("label")).alias("label"))


@query("text_id", "SELECT doc_id, translate(base64(encode(concat('ENTREZ ', text, ' CUI'))), '+/', '-_') AS atui FROM documents")
def text_id(inputs: Inputs) -> DataFrame:
    return inputs.table("documents").select("doc_id", codes.text_id(F.col("text")).alias("atui"))


VIEWS["fx_evidence"] = """
SELECT concat('ORD_', CAST(o_orderkey AS STRING)) AS node_id, CASE o_orderstatus WHEN 'P' THEN 'None' ELSE CAST(o_custkey AS STRING) END AS lowerbound,
  CASE o_orderstatus WHEN 'F' THEN '' ELSE concat(CAST(o_orderkey AS STRING), '.5') END AS upperbound,
  CASE o_orderstatus WHEN 'O' THEN NULL ELSE '7' END AS value, CASE o_orderstatus WHEN 'O' THEN 'nan' ELSE 'mm' END AS unit FROM orders"""


@query("evidence_defaults", """
SELECT node_id, coalesce(TRY_CAST(lowerbound AS DOUBLE), 0) AS lowerbound, coalesce(TRY_CAST(upperbound AS DOUBLE), 0) AS upperbound,
  coalesce(TRY_CAST(value AS DOUBLE), 0) AS value, CASE WHEN unit = 'nan' THEN '' ELSE unit END AS unit FROM fx_evidence
""")
def evidence_defaults(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_evidence")
    return rows.select("node_id", *oneshot.evidence_defaults(rows))


VIEWS["fx_unlabelled"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS node_id, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderpriority END AS label FROM orders"""


@query("default_label", "SELECT node_id, coalesce(label, node_id) AS label FROM fx_unlabelled")
def default_label(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_unlabelled").select("node_id", text.default_label(F.col("label"), F.col("node_id")).alias("label"))


@query("custom_props", "SELECT node_id, 'unit' AS key, unit AS value FROM fx_nodes UNION ALL SELECT node_id, 'value', coalesce(CAST(value AS STRING), '') FROM fx_nodes")
def custom_props(inputs: Inputs) -> DataFrame:
    nodes = inputs.view("fx_nodes")
    props = text.custom_props(nodes, [*tables.NODE_COLUMNS, "ord"])
    return nodes.select("node_id", F.explode(props).alias("key", "value"))


VIEWS["fx_scalar_or_list"] = """
SELECT event_id, CASE event_type WHEN 'click' THEN concat('["', event_type, '","', CAST(user_id AS STRING), '"]') ELSE props END AS value FROM events"""


@query("scalar_or_list", """
SELECT event_id, value AS item FROM fx_scalar_or_list WHERE value NOT LIKE '[%'
UNION ALL SELECT event_id, unnest(from_json(value, '["VARCHAR"]')) FROM fx_scalar_or_list WHERE value LIKE '[%'
""")
def scalar_or_list(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_scalar_or_list").select("event_id", F.explode(text.list_or_scalar(F.col("value"))).alias("item"))


VIEWS["fx_key_values"] = """
SELECT l_orderkey, l_partkey, l_linenumber, concat('order_id "', CAST(l_orderkey AS STRING), '"; tag "', l_returnflag, '"; line ',
  CAST(l_linenumber AS STRING), '; tag "', l_linestatus, '";') AS cell FROM lineitem"""


@query("kv_collect", """
SELECT l_orderkey, l_partkey, CAST(l_orderkey AS STRING) AS order_id, concat(l_returnflag, ',', l_linestatus) AS tag,
  CAST(l_linenumber AS STRING) AS line, '' AS absent FROM lineitem
""")
def kv_collect(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_key_values").withColumnRenamed("cell", "column_9")
    return annotations.split_key_values(rows, ["order_id", "tag", "line", "absent"]).drop("l_linenumber")


VIEWS["fx_lines"] = """
SELECT doc_id, concat(source, chr(9), lang, CASE WHEN n_chars > 500 THEN concat(chr(9), 'long', chr(9), source) ELSE '' END, chr(9), text) AS line FROM documents"""


@query("field_count_check", """
SELECT * FROM (SELECT doc_id, CAST(length(line) - length(replace(line, chr(9), '')) + 1 AS BIGINT) AS n_fields FROM fx_lines) WHERE n_fields <> 3
""")
def field_count_check(inputs: Inputs) -> DataFrame:
    return tables.field_count_check(inputs.view("fx_lines"), "line", 3).select("doc_id", "n_fields")


VIEWS["fx_listed"] = """
SELECT node_id, CASE WHEN node_synonyms = '' THEN 'None' ELSE node_synonyms END AS node_synonyms,
  CASE WHEN unit = '5-LOW' THEN 'None' ELSE unit END AS node_dbxrefs FROM fx_nodes"""


@query("non_null_report", """
SELECT count(*) AS n_rows, count(*) FILTER (node_synonyms NOT LIKE '%None%') AS n_synonyms, count(*) FILTER (node_dbxrefs NOT LIKE '%None%') AS n_dbxrefs,
  count(*) FILTER (node_synonyms NOT LIKE '%None%' AND node_dbxrefs NOT LIKE '%None%') AS n_both FROM fx_listed
""")
def non_null_report(inputs: Inputs) -> DataFrame:
    return triples.non_null_report(inputs.view("fx_listed"))


VIEWS["fx_features"] = """
SELECT l_returnflag AS feature_type, concat('chr', CAST(l_linenumber AS STRING)) AS chromosome_name, l_orderkey, l_partkey, l_linestatus FROM lineitem"""


@query("feature_filter", "SELECT feature_type, chromosome_name, l_orderkey FROM fx_features WHERE feature_type IN ('A', 'R')")
def feature_filter(inputs: Inputs) -> DataFrame:
    rows = annotations.filter_features(inputs.view("fx_features"), ["A", "R"])
    return annotations.filter_columns(rows, ["feature_type", "chromosome_name", "l_orderkey"])


@query("dedupe_rows", """
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_after FROM documents
""")
def dedupe_rows(inputs: Inputs) -> DataFrame:
    return dedupe_counts(inputs.table("documents").select("text", "lang"))


VIEWS["fx_wide_a"] = "SELECT CAST(c_custkey AS STRING) AS entry, c_mktsegment AS organism FROM customer"
VIEWS["fx_wide_b"] = "SELECT CAST(s_suppkey AS STRING) AS entry, s_name AS name FROM supplier"


@query("multi_file_union", """
SELECT entry, organism, CAST(NULL AS STRING) AS name FROM fx_wide_a UNION ALL SELECT entry, NULL, name FROM fx_wide_b
""")
def multi_file_union(inputs: Inputs) -> DataFrame:
    return tables.union_sources([inputs.view("fx_wide_a"), inputs.view("fx_wide_b")])


@query("widen_columns", "SELECT entry, organism, '' AS name, '' AS gene FROM fx_wide_a")
def widen_columns(inputs: Inputs) -> DataFrame:
    return tables.widen_columns(inputs.view("fx_wide_a"), ["organism", "name", "gene"])
