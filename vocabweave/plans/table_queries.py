"""Queries over readers and writers, relation names and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.operators import quality, relations
from vocabweave.plans.catalog import VIEWS, Inputs, query
from vocabweave.plans.graph_queries import base_graph
from vocabweave.session import shared_folder
from vocabweave.sources import tables

# ---- text files --------------------------------------------------------------------------

VIEWS["fx_file_nodes"] = """
SELECT node_id, node_label, node_definition, node_synonyms, '' AS node_dbxrefs, unit FROM fx_nodes"""


@query("read_source_tables", """
SELECT 'node' AS kind, node_id AS a, node_label AS b, node_definition AS c, CAST(len(string_split(node_synonyms, '|')) AS BIGINT) AS n_synonyms, unit FROM fx_file_nodes
UNION ALL SELECT 'edge', subject, predicate, object, 0, '' FROM fx_edges
""")
def read_source_tables(inputs: Inputs) -> DataFrame:
    folder = shared_folder(inputs.spark, "source")
    tables.write_text_table(inputs.view("fx_file_nodes"), f"{folder}/nodes")
    tables.write_text_table(inputs.sql("SELECT subject, predicate, object FROM fx_edges"), f"{folder}/edges")
    edges, nodes = tables.read_source(inputs.spark, f"{folder}/edges", f"{folder}/nodes")
    named = lambda kind, columns, n, unit: [F.lit(kind).alias("kind"), *(F.col(c).alias(a) for a, c in zip("abc", columns)), n.cast("bigint").alias("n_synonyms"), unit.alias("unit")]
    return nodes.select(named("node", ["node_id", "node_label", "node_definition"], F.size("node_synonyms"), F.col("unit"))).unionByName(
        edges.select(named("edge", tables.EDGE_COLUMNS, F.lit(0), F.lit("")))
    )


VIEWS["fx_text_rows"] = """
SELECT l_returnflag AS flag, coalesce(nullif(l_linestatus, 'O'), '') AS status, concat('"', CAST(l_partkey AS STRING)) AS part FROM lineitem"""


@query("text_scan_distinct", "SELECT DISTINCT flag, status, part FROM fx_text_rows")
def text_scan_distinct(inputs: Inputs) -> DataFrame:
    folder = shared_folder(inputs.spark, "scan")
    # one column whose name is the header; its rows are longer than that
    lines = inputs.sql("SELECT concat(flag, chr(9), status, chr(9), part, chr(9), 'extra') AS value FROM fx_text_rows")
    lines.toDF("flag\tstatus\tpart").write.option("header", True).option("sep", "\x01").option("quote", "").csv(folder)
    return tables.scan_text_distinct(inputs.spark, folder)


# ---- documents ---------------------------------------------------------------------------

VIEWS["fx_registry"] = """
SELECT concat('{"SAB', CAST(s_suppkey AS STRING), '":{"source_type":"', CASE WHEN s_nationkey > 12 THEN 'owl' ELSE 'edge_node' END,
  '","name":"', s_name, '","description":"supplier","history":{"download_size_mb":1.5,"parse_time_seconds":', CAST(s_nationkey AS STRING), '}}}') AS value FROM supplier"""


@query("source_registry", """
SELECT concat('SAB', CAST(s_suppkey AS STRING)) AS sab, CASE WHEN s_nationkey > 12 THEN 'owl' ELSE 'edge_node' END AS source_type, s_name AS name,
  CAST(NULL AS STRING) AS version, s_nationkey AS seconds FROM supplier
""")
def source_registry(inputs: Inputs) -> DataFrame:
    registry = tables.source_registry(inputs.view("fx_registry"))
    return registry.select("sab", "source_type", "name", "version", F.col("history.parse_time_seconds").alias("seconds"))


VIEWS["fx_relation_documents"] = """
SELECT concat('{"graphs":[{"nodes":[{"id":"R', CAST(p_partkey AS STRING), '","lbl":"', p_name, '","meta":{"definition":{"val":"', p_type,
  '"}}},{"id":"S', CAST(p_partkey AS STRING), '"}],"edges":[{"sub":"R', CAST(p_partkey AS STRING), '","pred":"inverseOf","obj":"S', CAST(p_partkey AS STRING), '"}]}]}') AS value FROM part"""


@query("relation_reference", """
SELECT 'node' AS kind, concat('R', CAST(p_partkey AS STRING)) AS a, p_name AS b, p_type AS c FROM part
UNION ALL SELECT 'node', concat('S', CAST(p_partkey AS STRING)), NULL, NULL FROM part
UNION ALL SELECT 'edge', concat('R', CAST(p_partkey AS STRING)), 'inverseOf', concat('S', CAST(p_partkey AS STRING)) FROM part
""")
def relation_reference(inputs: Inputs) -> DataFrame:
    nodes, edges = relations.read_relation_reference(inputs.view("fx_relation_documents"))
    return nodes.select(F.lit("node").alias("kind"), F.col("id").alias("a"), F.col("lbl").alias("b"), F.col("def").alias("c")).unionByName(
        edges.select(F.lit("edge").alias("kind"), F.col("sub").alias("a"), F.col("pred").alias("b"), F.col("obj").alias("c"))
    )


VIEWS["fx_objects"] = """
SELECT concat('{"labels":["Concept","Part"],"properties":{"id":"', codeid, '","pref_term":"', end_id, '","sab":"PART"}}') AS value, ord FROM fx_coderels
UNION ALL SELECT concat('{"labels":["Term"],"properties":{"id":"', end_id, '"}}'), ord FROM fx_coderels
UNION ALL SELECT concat('{"labels":["Rel_Label"],"properties":{"id":"', id, '","rel_label":"', rel_label, '","def":"","sab":"UMLS"}}'), ord FROM fx_rel_labels
UNION ALL SELECT concat('{"labels":["Node_Label"],"properties":{"id":"L:', r_name, '","node_label":"', r_name, '","def":"","sab":"L"}}'), r_regionkey FROM region
UNION ALL SELECT concat('{"labels":["Source"],"properties":{"id":"N:', n_name, '","name":"', n_name, '","sab":"N","srl":"', CAST(n_regionkey AS STRING), '.0","ttyl":["PT","SY"]}}'), n_nationkey FROM nation
UNION ALL SELECT concat('{"label":"CODE","start":{"properties":{"id":"', start_id, '"}},"end":{"properties":{"id":"', end_id, '"}},"properties":{"sab":"PART","codeid":"', codeid, '","tty":"PT","unit":"mm"}}'), ord FROM fx_coderels
UNION ALL SELECT concat('{"label":"', predicate, '","start":{"properties":{"id":"', subject, '"}},"end":{"properties":{"id":"', object, '"}},"properties":{"sab":"ORD","evidence_class":"', evidence_class, '"}}'), ord FROM fx_edges"""


def parsed_objects(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_objects")
    parsed = rows.select(F.from_json("value", tables.GRAPH_OBJECT).alias("o"), F.col("ord").cast("bigint").alias("ord"))
    return parsed.select("o.*", "ord").na.fill(0, ["step", "pos"])


@query("graph_split_kinds", """
SELECT 'concepts' AS kind, codeid AS id, end_id AS a, 'PART' AS b FROM fx_coderels
UNION ALL SELECT DISTINCT 'terms', end_id, '', '' FROM fx_coderels
UNION ALL SELECT 'rel_labels', id, rel_label, 'UMLS' FROM fx_rel_labels
UNION ALL SELECT 'node_labels', concat('L:', r_name), r_name, 'L' FROM region
UNION ALL SELECT 'sources', concat('N:', n_name), CAST(n_regionkey AS STRING), 'PT|SY' FROM nation
UNION ALL SELECT 'coderels', start_id, codeid, 'mm' FROM fx_coderels
UNION ALL SELECT 'rels', subject, object, evidence_class FROM fx_edges
""")
def graph_split_kinds(inputs: Inputs) -> DataFrame:
    graph = tables.graph_from_objects(parsed_objects(inputs))

    def rows(kind: str, df: DataFrame, *columns) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), *[c.alias(name) for c, name in zip(columns, ("id", "a", "b"))])

    blank = F.lit("")
    return tables.union_sources([
        rows("concepts", graph.concepts, F.col("id"), F.col("pref_term"), F.col("sab")),
        rows("terms", graph.terms, F.col("id"), blank, blank),
        rows("rel_labels", graph.rel_labels, F.col("id"), F.col("rel_label"), F.col("sab")),
        rows("node_labels", graph.node_labels, F.col("id"), F.col("node_label"), F.col("sab")),
        rows("sources", graph.sources, F.col("id"), F.col("srl").cast("string"), F.array_join("ttyl", "|")),
        rows("coderels", graph.coderels, F.col("start_id"), F.col("codeid"), F.col("props")["unit"]),
        rows("rels", graph.rels, F.col("start_id"), F.col("end_id"), F.col("props")["evidence_class"]),
    ])


@query("graph_sample", """
SELECT * FROM (SELECT 'rel_labels' AS kind, id FROM fx_rel_labels ORDER BY ord LIMIT 49)
UNION ALL SELECT * FROM (SELECT 'concepts', id FROM fx_concepts ORDER BY ord LIMIT (SELECT 50 - 1 - count(*) FROM fx_rel_labels))
UNION ALL SELECT * FROM (SELECT 'coderels', codeid FROM fx_coderels ORDER BY ord LIMIT 40)
""")
def graph_sample(inputs: Inputs) -> DataFrame:
    graph = tables.sample_graph(base_graph(inputs), max_nodes=50, max_rels=40)
    return tables.union_sources([
        graph.rel_labels.select(F.lit("rel_labels").alias("kind"), "id"),
        graph.concepts.select(F.lit("concepts").alias("kind"), "id"),
        graph.coderels.select(F.lit("coderels").alias("kind"), F.col("codeid").alias("id")),
    ])


@query("graph_to_json", """
SELECT 1 AS section, '{"labels":["Source"],"properties":{"id":"PART:PART","name":"PART","description":"","sab":"PART","source_version":"1","source":"","ttyl":["PT"]},"step":0}' AS value
UNION ALL SELECT 3, concat('{"labels":["Rel_Label"],"properties":{"id":"', id, '","rel_label":"', rel_label, '","def":"', def, '","sab":"', sab, '"},"step":0}') FROM fx_rel_labels
UNION ALL SELECT 4, concat('{"labels":["Concept"],"properties":{"id":"', id, '","pref_term":"', pref_term, '","sab":"', sab, '"},"step":0}') FROM fx_concepts
UNION ALL SELECT 5, concat('{"labels":["Term"],"properties":{"id":"', id, '"},"step":0}') FROM fx_terms
UNION ALL SELECT 7, concat('{"label":"CODE","start":{"properties":{"id":"', start_id, '"}},"end":{"properties":{"id":"', end_id,
  '"}},"properties":{"sab":"', sab, '","def":"","codeid":"', codeid, '","tty":"', tty, '"},"step":0,"pos":0}') FROM fx_coderels
""")
def graph_to_json(inputs: Inputs) -> DataFrame:
    return tables.graph_objects(base_graph(inputs)).select("section", "value")


# ---- relations ---------------------------------------------------------------------------

VIEWS["fx_relation_nodes"] = """
SELECT concat('http://purl.obolibrary.org/obo/RO_', lpad(CAST(p_partkey AS STRING), 7, '0')) AS id,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat(p_name, ' of ', p_brand) END AS lbl, p_type AS def, p_partkey AS ord FROM part"""
VIEWS["fx_relation_edges"] = """
SELECT concat('http://purl.obolibrary.org/obo/RO_', lpad(CAST(p_partkey AS STRING), 7, '0')) AS sub,
       CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'inverseOf' ELSE 'subPropertyOf' END AS pred,
       concat('http://purl.obolibrary.org/obo/RO_', lpad(CAST(p_size AS STRING), 7, '0')) AS obj, p_partkey AS ord FROM part"""
VIEWS["fx_spatial_nodes"] = """
SELECT concat('http://purl.obolibrary.org/obo/BSPO_', lpad(CAST(s_suppkey AS STRING), 7, '0')) AS id, s_name AS lbl, s_suppkey AS ord FROM supplier"""
VIEWS["fx_raw_edges"] = """
SELECT concat('ORD:', CAST(l_orderkey AS STRING)) AS subject, CASE l_linenumber
         WHEN 1 THEN concat('http://purl.obolibrary.org/obo/RO_', lpad(CAST(l_partkey AS STRING), 7, '0'))
         WHEN 2 THEN concat('RO:', lpad(CAST(l_partkey AS STRING), 7, '0'))
         WHEN 3 THEN concat('http://example.org/core/', p_name, ' of ', p_brand)
         WHEN 4 THEN concat('http://purl.obolibrary.org/obo/BSPO_', lpad(CAST(l_suppkey AS STRING), 7, '0'))
         WHEN 5 THEN concat('http://example.org/x#is ', l_returnflag, '-', l_linestatus)
         WHEN 6 THEN CASE l_returnflag WHEN 'A' THEN 'http://www.w3.org/2000/01/rdf-schema#subClassOf'
              WHEN 'N' THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' ELSE 'http://www.ebi.ac.uk/efo/EFO_0000784' END
         ELSE concat('2d part (', CAST(l_suppkey AS STRING), ')') END AS predicate,
       concat('PART:', CAST(l_partkey AS STRING)) AS object
FROM lineitem JOIN part ON l_partkey = p_partkey"""

VIEWS["ox_inverse_pairs"] = """
SELECT n.id, lower(n.id) AS iri, split_part(replace(n.lbl, ' ', '_'), '/', -1) AS label, split_part(replace(i.lbl, ' ', '_'), '/', -1) AS inverse_label, n.ord
FROM fx_relation_nodes n LEFT JOIN (
  SELECT sub AS id, arg_min(obj, ord) AS other FROM fx_relation_edges WHERE pred = 'inverseOf' GROUP BY sub
  UNION ALL SELECT obj, arg_min(sub, ord) FROM fx_relation_edges WHERE pred = 'inverseOf'
    AND obj NOT IN (SELECT sub FROM fx_relation_edges WHERE pred = 'inverseOf') GROUP BY obj) x ON x.id = n.id
LEFT JOIN fx_relation_nodes i ON i.id = x.other"""
VIEWS["ox_relation_names"] = r"""
SELECT predicate, CASE WHEN regexp_matches(f, '^\pN') THEN concat('rel_', f) ELSE f END AS relation_label,
       CASE WHEN regexp_matches(g, '^\pN') THEN concat('rel_', g) ELSE g END AS inverse_label
FROM (SELECT predicate, lower(translate(label, '.-()[]{}: ', '__________')) AS f,
             lower(translate(coalesce(inv, concat('inverse_', label)), '.-()[]{}: ', '__________')) AS g
  FROM (SELECT predicate, inv, CASE WHEN predicate LIKE '%rdf-syntax-ns#type' OR contains(l0, 'subClassOf') THEN 'isa'
               WHEN lower(l0) LIKE '%efo_0000784' THEN 'has_disease_location' ELSE l0 END AS label
    FROM (SELECT p.predicate, coalesce(a.inverse_label, b.inverse_label, c.inverse_label) AS inv,
                 coalesce(a.label, b.label, c.label, lower(s.lbl), CASE WHEN contains(p.predicate, '#') THEN split_part(p.predicate, '#', -1) END,
                          split_part(p.predicate, '/', -1)) AS l0
      FROM (SELECT DISTINCT predicate FROM fx_raw_edges) p
      LEFT JOIN ox_inverse_pairs a ON a.iri = lower(p.predicate)
      LEFT JOIN ox_inverse_pairs b ON b.iri = concat('http://purl.obolibrary.org/obo/', replace(lower(p.predicate), ':', '_'))
      LEFT JOIN (SELECT label, arg_min(coalesce(inverse_label, chr(1)), ord) AS inv0, nullif(arg_min(coalesce(inverse_label, chr(1)), ord), chr(1)) AS inverse_label
                 FROM ox_inverse_pairs WHERE label IS NOT NULL GROUP BY label) c
             ON c.label = split_part(translate(p.predicate, ' #', '_/'), '/', -1)
      LEFT JOIN fx_spatial_nodes s ON lower(s.id) = lower(p.predicate))))"""


def relation_tables(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    return relations.relation_inverses(inputs.view("fx_relation_nodes"), inputs.view("fx_relation_edges")), inputs.view("fx_spatial_nodes")


@query("relation_inverse_pairs", "SELECT iri, label, inverse_label FROM ox_inverse_pairs")
def relation_inverse_pairs(inputs: Inputs) -> DataFrame:
    return relation_tables(inputs)[0].select("iri", "label", "inverse_label")


@query("relation_inverse", "SELECT * FROM ox_relation_names")
def relation_inverse(inputs: Inputs) -> DataFrame:
    return relations.relation_names(inputs.view("fx_raw_edges"), *relation_tables(inputs))


@query("relation_standardize", """
SELECT subject, relation_label AS predicate, object FROM fx_raw_edges JOIN ox_relation_names USING (predicate)
""")
def relation_standardize(inputs: Inputs) -> DataFrame:
    return relations.standardize_relations(inputs.view("fx_raw_edges"), *relation_tables(inputs))


# ---- quality -----------------------------------------------------------------------------

VIEWS["fx_dq_sources"] = "SELECT CASE WHEN n_regionkey = 1 THEN n_name ELSE concat('N:', n_name) END AS id, CASE WHEN n_regionkey = 2 THEN '' ELSE n_name END AS name, CASE WHEN n_regionkey = 3 THEN 'N:X' ELSE 'N' END AS sab FROM nation"
VIEWS["fx_dq_node_labels"] = "SELECT concat('P:', p_name) AS id, CASE WHEN p_size > 30 THEN p_name ELSE p_type END AS node_label, 'P' AS sab, p_brand AS def FROM part"
VIEWS["fx_dq_rel_labels"] = "SELECT concat('E:', event_type) AS id, CASE WHEN user_id > 20 THEN upper(event_type) ELSE event_type END AS rel_label, 'E' AS sab, CASE WHEN value > 10 THEN NULL ELSE props END AS def FROM events"
VIEWS["fx_dq_concepts"] = "SELECT node_id AS id, CASE WHEN unit = '5-LOW' THEN '' ELSE node_label END AS pref_term, 'ORD' AS sab FROM fx_nodes"
VIEWS["fx_dq_terms"] = "SELECT node_label AS id FROM fx_nodes UNION ALL SELECT node_synonyms FROM fx_nodes"
VIEWS["fx_dq_coderels"] = "SELECT CASE WHEN tty = 'X' THEN '' ELSE start_id END AS start_id, end_id, CASE WHEN ord > 100 THEN sab ELSE '' END AS sab, def, CASE WHEN ord < 50 THEN end_id ELSE codeid END AS codeid, tty FROM fx_coderels"
VIEWS["fx_dq_rels"] = "SELECT label, start_id, CASE WHEN label = 'view' THEN replace(end_id, ':', ' ') ELSE end_id END AS end_id, sab FROM fx_rels"

DQ_TABLES = ("sources", "node_labels", "rel_labels", "concepts", "terms", "coderels", "rels")


def dq_tables(inputs: Inputs) -> dict[str, DataFrame]:
    return {name: inputs.view(f"fx_dq_{name}") for name in DQ_TABLES}


def _count(rule: str, view: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER ({condition}) AS n_broken FROM {view}"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_blank = "coalesce({0}, '') = ''"
_no_colon = "NOT contains(coalesce({0}, ''), ':')"
_named = ("sources", "node_labels", "rel_labels", "concepts")

VIEWS["fx_dq_objects"] = """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Concept' WHEN '2-HIGH' THEN 'Term' WHEN '3-MEDIUM' THEN 'Other' ELSE 'Source' END AS first_label,
  CASE o_orderstatus WHEN 'P' THEN 'Concept' WHEN 'F' THEN 'Extra' ELSE '' END AS second_label FROM orders"""


@query("dq_labels", """
WITH n AS (SELECT CASE WHEN first_label IN ('Concept', 'Term', 'Source') THEN 1 ELSE 0 END + CASE WHEN second_label = 'Concept' THEN 1 ELSE 0 END AS core,
  CASE WHEN second_label = '' THEN 1 ELSE 2 END AS size, (first_label = 'Concept' OR second_label = 'Concept') AS concept, first_label = second_label AS twice FROM fx_dq_objects)
SELECT 'one_core_label' AS rule, count(*) FILTER (core <> 1) AS n_broken FROM n
UNION ALL SELECT 'extra_only_on_concept', count(*) FILTER (size > core AND NOT concept) FROM n
UNION ALL SELECT 'labels_unique', count(*) FILTER (twice) FROM n
""")
def dq_labels(inputs: Inputs) -> DataFrame:
    labels = F.filter(F.array("first_label", "second_label"), lambda label: label != "")
    return quality.label_rules(inputs.view("fx_dq_objects").select(labels.alias("labels")))


@query("dq_ids", _union([_count(f"{t}_id_colon", f"fx_dq_{t}", _no_colon.format("id")) for t in _named] + [_count("terms_id", "fx_dq_terms", _blank.format("id"))]))
def dq_ids(inputs: Inputs) -> DataFrame:
    return quality.id_rules(dq_tables(inputs))


@query("dq_required", _union([_count(f"{t}_{c}_required", f"fx_dq_{t}", _blank.format(c)) for t in _named for c in quality.REQUIRED[t]]))
def dq_required(inputs: Inputs) -> DataFrame:
    return quality.required_rules(dq_tables(inputs))


@query("dq_patterns", _union([
    _count("node_label_format", "fx_dq_node_labels", "NOT regexp_matches(node_label, '^[A-Z]+')"),
    _count("rel_label_format", "fx_dq_rel_labels", "NOT regexp_full_match(rel_label, '[a-z][a-z0-9_]*')"),
    *[_count(f"{t}_sab_colon", f"fx_dq_{t}", "contains(sab, ':')") for t in _named],
]))
def dq_patterns(inputs: Inputs) -> DataFrame:
    return quality.pattern_rules(dq_tables(inputs))


@query("dq_rels", _union([
    _count("coderel_sab", "fx_dq_coderels", _blank.format("sab")), _count("coderel_codeid", "fx_dq_coderels", _no_colon.format("codeid")),
    _count("coderel_tty", "fx_dq_coderels", _blank.format("tty")), _count("coderel_start", "fx_dq_coderels", _no_colon.format("start_id")),
    _count("rel_sab", "fx_dq_rels", _blank.format("sab")), _count("rel_start", "fx_dq_rels", _no_colon.format("start_id")),
    _count("rel_end", "fx_dq_rels", _no_colon.format("end_id")),
]))
def dq_rels(inputs: Inputs) -> DataFrame:
    views = dq_tables(inputs)
    return quality.link_rules(views["coderels"], views["rels"])


VIEWS["fx_dq_evidence"] = "SELECT node_id, CASE WHEN unit = 'mm' THEN 'size' ELSE '' END AS attribute, value, lowerbound, upperbound, unit FROM fx_evidence"


@query("dq_dependent", _union([
    _count(f"{k}_needs_attribute", "fx_dq_evidence", f"coalesce({k}, '') <> '' AND attribute = ''") for k in ("value", "lowerbound", "upperbound", "unit")
]))
def dq_dependent(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_dq_evidence")
    keys = [c for c in rows.columns if c != "node_id"]
    props = F.create_map(*[item for k in keys for item in (F.lit(k), F.col(k))])
    return quality.dependent_rules(rows.select(props.alias("props")))


_unique = {
    **{t: "id" for t in (*_named, "terms")}, "rels": "label, start_id, end_id, sab", "coderels": "start_id, end_id, sab, def, codeid, tty",
}


@query("dq_unique", _union([
    *[f"SELECT '{t}_unique' AS rule, (SELECT count(*) FROM fx_dq_{t}) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM fx_dq_{t})) AS n_broken" for t, k in _unique.items()],
    "SELECT 'two_nodes', CAST(0 AS BIGINT)", "SELECT 'one_link', CAST(0 AS BIGINT)",
]))
def dq_unique(inputs: Inputs) -> DataFrame:
    return quality.unique_rules(dq_tables(inputs))


VIEWS["fx_dq_codes"] = "SELECT raw AS codeid FROM fx_raw_codes UNION ALL SELECT codeid FROM fx_coderels"


@query("dq_codeid", "SELECT 'codeid_format' AS rule, count(*) FILTER (NOT regexp_full_match(codeid, '[A-Za-z0-9._-]+:[A-Za-z0-9._-]+( CUI)?')) AS n_broken FROM fx_dq_codes")
def dq_codeid(inputs: Inputs) -> DataFrame:
    return quality.code_format_rule(inputs.view("fx_dq_codes"))
