"""Queries that resolve concepts, fold sources into the graph and ask the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.functions.codes import standardize_dbxref
from vocabweave.functions.text import pipe_split, standardize_synonyms
from vocabweave.operators import graph_queries as ask
from vocabweave.operators import resolve
from vocabweave.operators.keyed import dense_number, first_per_key, hashed_side
from vocabweave.plans import ingest
from vocabweave.plans.catalog import VIEWS, Inputs, query
from vocabweave.session import cut_lineage, shared_folder
from vocabweave.sources import tables
from vocabweave.sources.field_vocabulary import padded_id
from vocabweave.sources.known import store_known
from vocabweave.sources.tables import Graph


def base_coderels(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_coderels").select(
        "*", F.create_map().cast("map<string,string>").alias("props"), F.lit(0).alias("step"), F.lit(0).cast("bigint").alias("pos")
    )


def base_graph(inputs: Inputs) -> Graph:
    empty = tables.empty_graph(inputs.spark)
    step = F.lit(0).alias("step")
    return Graph(
        sources=inputs.sql(
            "SELECT DISTINCT concat(sab, ':', sab) AS id, sab AS name, '' AS description, sab, '1' AS source_version, '' AS source, "
            "CAST(NULL AS INT) AS srl, array('PT') AS ttyl, 0 AS step, CAST(0 AS BIGINT) AS ord FROM fx_coderels"
        ),
        node_labels=empty.node_labels,
        rel_labels=inputs.view("fx_rel_labels").select("*", step),
        concepts=inputs.view("fx_concepts").select(F.array(F.lit("Concept")).alias("labels"), "*", step),
        terms=inputs.view("fx_terms").select("*", step),
        coderels=base_coderels(inputs),
        rels=empty.rels,
    )


def source_edges(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_edges")


def source_nodes(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_nodes").withColumn("node_synonyms", pipe_split(F.col("node_synonyms"))).withColumn(
        "node_dbxrefs", F.array(F.lit(""))
    )


def source_xrefs(inputs: Inputs) -> DataFrame:
    spelled = standardize_dbxref(F.col("dbxref")).alias("xref")
    return inputs.view("fx_xrefs").select("node_id", "xref_ord", spelled)


def source_row(inputs: Inputs, sab: str) -> DataFrame:
    return inputs.spark.createDataFrame(
        [(f"{sab}:{sab}", sab, "", sab, "1", "", None, ["PT", "SY"])],
        "id string, name string, description string, sab string, source_version string, source string, srl int, ttyl array<string>",
    )


def whole_nodes(inputs: Inputs) -> DataFrame:
    return resolve.complete_nodes(source_edges(inputs), source_nodes(inputs))


def choice(inputs: Inputs) -> DataFrame:
    nodes = cut_lineage(whole_nodes(inputs).select("node_id"))
    candidates = cut_lineage(resolve.candidate_concepts(nodes, cut_lineage(source_xrefs(inputs)), base_coderels(inputs)))
    return cut_lineage(resolve.ranked_choice(nodes, candidates))


def ingested(inputs: Inputs) -> ingest.Ingest:
    return ingest.ingest_source(
        base_graph(inputs), source_edges(inputs), source_nodes(inputs), source_row(inputs, "ORD"), "ORD", xrefs=source_xrefs(inputs)
    )


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def first_order(inputs: Inputs) -> DataFrame:
    return first_per_key(inputs.table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("missing_nodes", "SELECT node_id FROM ox_missing")
def missing_nodes(inputs: Inputs) -> DataFrame:
    return resolve.missing_nodes(source_edges(inputs), source_nodes(inputs))


@query("xref_transitive", "SELECT node_id, rnk AS rank, xref_ord, cui FROM ox_candidates WHERE rnk IN (2, 3)")
def xref_transitive(inputs: Inputs) -> DataFrame:
    return resolve.transitive_concepts(cut_lineage(source_xrefs(inputs)), base_coderels(inputs)).select("node_id", "rank", "xref_ord", "cui")


@query("node_existing_cui", "SELECT node_id, cui FROM ox_candidates WHERE rnk = 4")
def node_existing_cui(inputs: Inputs) -> DataFrame:
    return resolve.existing_concepts(whole_nodes(inputs), base_coderels(inputs)).select("node_id", "cui")


@query("preferred_concept", "SELECT node_id, rnk AS rank, cui FROM ox_choice")
def preferred_concept(inputs: Inputs) -> DataFrame:
    return choice(inputs)


@query("preferred_concept_exclusive", "SELECT node_id, rnk AS rank, first_cui, assigned_cui FROM ox_assigned")
def preferred_concept_exclusive(inputs: Inputs) -> DataFrame:
    return resolve.resolve_shared(choice(inputs)).drop("assignment_comment")


@query("shared_concepts", "SELECT cui, count(*) AS n_nodes FROM ox_choice GROUP BY cui HAVING count(*) > 1")
def shared_concepts(inputs: Inputs) -> DataFrame:
    return resolve.shared_concepts(choice(inputs))


@query("shared_concept_members", "SELECT first_cui, node_id FROM ox_assigned WHERE first_cui IN (SELECT cui FROM ox_choice GROUP BY cui HAVING count(*) > 1)")
def shared_concept_members(inputs: Inputs) -> DataFrame:
    return resolve.shared_members(resolve.resolve_shared(choice(inputs))).select("first_cui", "node_id")


@query("preferred_concept_greedy", """
WITH RECURSIVE members AS MATERIALIZED (
  SELECT c.node_id, c.cui AS grp, row_number() OVER (PARTITION BY c.cui ORDER BY n.ord, c.node_id) AS k FROM ox_choice c JOIN ox_nodes n ON c.node_id = n.node_id
  WHERE c.cui IN (SELECT cui FROM ox_choice GROUP BY cui HAVING count(*) > 1)),
options AS MATERIALIZED (
  SELECT node_id, list(cui ORDER BY rnk, xref_ord, cord, cui) AS cuis FROM (
    SELECT *, row_number() OVER (PARTITION BY node_id, cui ORDER BY rnk, xref_ord, cord) AS rn FROM ox_candidates) WHERE rn = 1 GROUP BY node_id),
queue AS MATERIALIZED (SELECT m.grp, m.k, m.node_id, coalesce(o.cuis, CAST([] AS VARCHAR[])) AS cuis FROM members m LEFT JOIN options o ON m.node_id = o.node_id),
walked AS (
  SELECT DISTINCT grp, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS node_id, CAST(NULL AS VARCHAR) AS pick FROM members
  UNION ALL
  SELECT grp, k, CASE WHEN free IS NULL THEN taken ELSE list_append(taken, free) END, node_id, coalesce(free, node_id) FROM (
    SELECT q.grp, q.k, w.taken, q.node_id, list_filter(q.cuis, lambda c: NOT list_contains(w.taken, c))[1] AS free
    FROM walked w JOIN queue q ON q.grp = w.grp AND q.k = w.k + 1))
SELECT c.node_id, c.rnk AS rank, c.cui AS first_cui, coalesce(w.pick, c.cui) AS assigned_cui
FROM ox_choice c LEFT JOIN (SELECT node_id, pick FROM walked WHERE k > 0) w ON c.node_id = w.node_id
""")
def preferred_concept_greedy(inputs: Inputs) -> DataFrame:
    nodes = cut_lineage(whole_nodes(inputs).select("node_id", "ord"))
    assigned, _ = resolve.assign_concepts(nodes, base_coderels(inputs), "greedy", source_xrefs(inputs))
    return assigned.select("node_id", "rank", "first_cui", "assigned_cui")


@query("cui_lists", "SELECT node_id, pos, cui FROM ox_lists")
def cui_lists(inputs: Inputs) -> DataFrame:
    nodes = cut_lineage(whole_nodes(inputs).select("node_id"))
    _, listed = resolve.assign_concepts(nodes, base_coderels(inputs), xrefs=source_xrefs(inputs))
    return listed.select("node_id", "pos", "cui")


@query("edges_to_rels", "SELECT label, start_id, end_id, sab, evidence_class FROM ox_rels")
def edges_to_rels(inputs: Inputs) -> DataFrame:
    assigned = cut_lineage(resolve.resolve_shared(choice(inputs)))
    rels = ingest.edges_to_rels(source_edges(inputs), hashed_side(assigned), "ORD")
    return rels.select("label", "start_id", "end_id", "sab", F.col("props")["evidence_class"].alias("evidence_class"))


VIEWS["fx_part_edges"] = """
SELECT concat('PART:', CAST(l_partkey AS STRING)) AS subject, 'sold_with' AS predicate, concat('PART:', CAST(l_suppkey AS STRING)) AS object,
       l_orderkey * 10 + l_linenumber AS ord FROM lineitem"""


@query("self_edges", """
SELECT e.subject AS code, s.start_id AS cui, count(*) AS n_edges FROM fx_part_edges e JOIN fx_coderels s ON e.subject = s.codeid
JOIN fx_coderels o ON e.object = o.codeid WHERE s.start_id = o.start_id GROUP BY 1, 2
""")
def self_edges(inputs: Inputs) -> DataFrame:
    concepts = base_coderels(inputs).select(F.col("codeid").alias("node_id"), F.col("start_id").alias("assigned_cui"))
    edges = inputs.view("fx_part_edges").withColumn("code", F.col("subject"))
    _, loops = ingest.split_self_edges(ingest.edges_to_rels(edges, concepts, "PART"))
    return loops.groupBy(F.col("props")["code"].alias("code"), F.col("start_id").alias("cui")).agg(F.count(F.lit(1)).alias("n_edges"))


VIEWS["fx_sabs"] = "SELECT upper(p_type) AS sab FROM part UNION SELECT lower(c_mktsegment) FROM customer"


@query("source_exists", """
SELECT sab, upper(sab) IN (SELECT c_mktsegment FROM customer) AS known FROM fx_sabs
""")
def source_exists(inputs: Inputs) -> DataFrame:
    sources = inputs.sql("SELECT c_mktsegment AS sab FROM customer")
    return ingest.mark_known_sources(inputs.view("fx_sabs"), sources)


@query("new_rel_labels", """
SELECT concat('ORD:', predicate) AS id, predicate AS rel_label, min(ord) AS ord FROM fx_edges
WHERE predicate NOT IN (SELECT rel_label FROM fx_rel_labels) GROUP BY predicate
""")
def new_rel_labels(inputs: Inputs) -> DataFrame:
    return ingest.new_rel_labels(source_edges(inputs), inputs.view("fx_rel_labels"), "ORD").select("id", "rel_label", "ord")


@query("new_concepts", """
SELECT cui AS id, node_label AS pref_term FROM (SELECT l.cui, n.node_label, row_number() OVER (PARTITION BY l.cui ORDER BY n.ord, l.pos, n.node_id) AS rn
  FROM ox_lists l JOIN ox_nodes n ON l.node_id = n.node_id) WHERE rn = 1 AND cui NOT IN (SELECT start_id FROM fx_coderels)
""")
def new_concepts(inputs: Inputs) -> DataFrame:
    nodes = cut_lineage(whole_nodes(inputs))
    _, listed = resolve.assign_concepts(nodes, base_coderels(inputs), xrefs=source_xrefs(inputs))
    return ingest.new_concepts(nodes, listed, base_coderels(inputs), "ORD").select("id", "pref_term")


@query("new_terms", """
SELECT DISTINCT node_label AS id, CAST(0 AS BIGINT) AS kind FROM ox_nodes WHERE node_label NOT IN (SELECT id FROM fx_terms)
UNION ALL SELECT DISTINCT syn, 1 FROM (SELECT unnest(string_split(node_synonyms, '|')) AS syn FROM ox_nodes)
WHERE syn <> '' AND syn NOT IN (SELECT node_label FROM ox_nodes) AND syn NOT IN (SELECT id FROM fx_terms)
""")
def new_terms(inputs: Inputs) -> DataFrame:
    nodes = whole_nodes(inputs).withColumn("node_synonyms", standardize_synonyms(F.col("node_synonyms")))
    return ingest.new_terms(nodes, inputs.view("fx_terms")).select("id", F.col("kind").cast("bigint").alias("kind"))


@query("coderels_build", "SELECT start_id, end_id, def, codeid, tty, unit FROM ox_coderels")
def coderels_build(inputs: Inputs) -> DataFrame:
    done = ingested(inputs)
    links = ingest.build_coderels(done.nodes, done.concept_list, "ORD")
    return links.select("start_id", "end_id", "def", "codeid", "tty", F.col("props")["unit"].alias("unit"))


@query("ingest_source", """
SELECT 'code' AS kind, tty AS label, start_id, end_id, codeid FROM ox_coderels
UNION ALL SELECT 'code', tty, start_id, end_id, codeid FROM fx_coderels
UNION ALL SELECT 'rel', label, start_id, end_id, '' FROM ox_rels WHERE start_id <> end_id
""")
def ingest_source(inputs: Inputs) -> DataFrame:
    graph = ingested(inputs).graph
    codes = graph.coderels.select(F.lit("code").alias("kind"), F.col("tty").alias("label"), "start_id", "end_id", "codeid")
    return codes.unionByName(graph.rels.select(F.lit("rel").alias("kind"), "label", "start_id", "end_id", F.lit("").alias("codeid")))


@query("ingest_source_bucketed", """
SELECT start_id, end_id, codeid, tty FROM ox_coderels UNION ALL SELECT start_id, end_id, codeid, tty FROM fx_coderels
UNION ALL SELECT cui, '', '', 'concept' FROM (SELECT DISTINCT cui FROM ox_lists WHERE cui NOT IN (SELECT start_id FROM fx_coderels))
UNION ALL SELECT t, '', '', 'term' FROM (SELECT DISTINCT node_label AS t FROM ox_nodes UNION SELECT unnest(string_split(node_synonyms, '|')) FROM ox_nodes)
  WHERE t NOT IN (SELECT id FROM fx_terms) AND (t <> '' OR t IN (SELECT node_label FROM ox_nodes))
""")
def ingest_source_bucketed(inputs: Inputs) -> DataFrame:
    """The same fold, with what the graph knows in bucketed tables."""
    graph = base_graph(inputs)
    known = store_known(graph, shared_folder(inputs.spark, "known"))
    done = ingest.ingest_source(
        graph, source_edges(inputs), source_nodes(inputs), source_row(inputs, "ORD"), "ORD", xrefs=source_xrefs(inputs), known=known
    ).graph
    none = F.lit("")
    new = lambda table, kind: table.where("step = 1").select(F.col("id").alias("start_id"), none.alias("end_id"), none.alias("codeid"), F.lit(kind).alias("tty"))
    links = done.coderels.select("start_id", "end_id", "codeid", "tty")
    return links.unionByName(new(done.concepts, "concept")).unionByName(new(done.terms, "term"))


@query("node_counts", """
WITH new_concept AS (SELECT count(DISTINCT cui) AS n FROM ox_lists WHERE cui NOT IN (SELECT start_id FROM fx_coderels)),
new_term AS (SELECT count(DISTINCT t) AS n FROM (SELECT node_label AS t FROM ox_nodes UNION ALL SELECT unnest(string_split(node_synonyms, '|')) FROM ox_nodes)
  WHERE t NOT IN (SELECT id FROM fx_terms) AND (t <> '' OR t IN (SELECT node_label FROM ox_nodes)))
SELECT 'Source' AS node_type, CAST(1 AS BIGINT) AS before, CAST(2 AS BIGINT) AS after
UNION ALL SELECT 'Node_Label', 0, 0
UNION ALL SELECT 'Rel_Label', (SELECT count(*) FROM fx_rel_labels), (SELECT count(*) FROM fx_rel_labels) + (SELECT count(DISTINCT predicate) FROM fx_edges WHERE predicate NOT IN (SELECT rel_label FROM fx_rel_labels))
UNION ALL SELECT 'Concept', (SELECT count(*) FROM fx_concepts), (SELECT count(*) FROM fx_concepts) + (SELECT n FROM new_concept)
UNION ALL SELECT 'Term', (SELECT count(*) FROM fx_terms), (SELECT count(*) FROM fx_terms) + (SELECT n FROM new_term)
UNION ALL SELECT 'CODE rels', (SELECT count(*) FROM fx_coderels), (SELECT count(*) FROM fx_coderels) + (SELECT count(*) FROM ox_coderels)
UNION ALL SELECT 'non-CODE rels', 0, (SELECT count(*) FROM ox_rels WHERE start_id <> end_id)
""")
def node_counts(inputs: Inputs) -> DataFrame:
    return ingested(inputs).counts


# ---- context: customers first, then orders that refer to them ----------------------------

VIEWS["fx_customer_nodes"] = """
SELECT concat('CUST:', CAST(c_custkey AS STRING)) AS node_id, c_name AS node_label, '' AS node_definition, c_mktsegment AS node_synonyms,
       CASE WHEN c_mktsegment = 'BUILDING' THEN concat('umls:c8', lpad(CAST(c_custkey AS STRING), 9, '0')) ELSE '' END AS node_dbxrefs, c_custkey AS ord FROM customer"""
VIEWS["fx_customer_edges"] = """
SELECT concat('CUST:', CAST(c_custkey AS STRING)) AS subject, 'located_in' AS predicate, concat('NATION:', CAST(c_nationkey AS STRING)) AS object, c_custkey AS ord FROM customer"""
VIEWS["fx_order_nodes"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS node_id, o_orderpriority AS node_label, '' AS node_definition, '' AS node_synonyms,
       concat('cust:', CAST(o_custkey AS STRING)) AS node_dbxrefs, o_orderkey AS ord FROM orders"""
VIEWS["fx_order_edges"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS subject, 'placed_by' AS predicate, concat('CUST:', CAST(o_custkey AS STRING)) AS object, o_orderkey AS ord FROM orders"""


@query("context_two_sources", """
WITH c AS (SELECT c_custkey, concat('CUST:', CAST(c_custkey AS STRING)) AS code, CASE WHEN c_mktsegment = 'BUILDING'
  THEN concat('UMLS:C8', lpad(CAST(c_custkey AS STRING), 9, '0')) ELSE concat('CUST:', CAST(c_custkey AS STRING)) END AS cui FROM customer),
o AS (SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS code, c.cui, count(*) OVER (PARTITION BY c.cui) + CASE WHEN u.c_custkey IS NULL THEN 0 ELSE 1 END AS n
  FROM orders JOIN c ON o_custkey = c.c_custkey LEFT JOIN c u ON u.c_custkey = c.c_custkey)
SELECT start_id, codeid, tty FROM (
  SELECT cui AS start_id, code AS codeid, 'PT' AS tty FROM c UNION ALL
  SELECT cui, code, 'SY' FROM c UNION ALL
  SELECT DISTINCT concat('NATION:', CAST(c_nationkey AS STRING)), concat('NATION:', CAST(c_nationkey AS STRING)), 'PT' FROM customer UNION ALL
  SELECT cui, code, 'PT' FROM o UNION ALL
  SELECT code, code, 'PT' FROM o WHERE n > 1 UNION ALL
  SELECT cui, code, 'PT' FROM (SELECT c.* FROM c WHERE c_custkey IN (SELECT o_custkey FROM orders)) UNION ALL
  SELECT code, code, 'PT' FROM c WHERE c_custkey IN (SELECT o_custkey FROM orders) AND cui <> code)
""")
def context_two_sources(inputs: Inputs) -> DataFrame:
    def load(edges: str, nodes: str, sab: str):
        return lambda: (inputs.view(edges), tables.list_columns(inputs.view(nodes)), source_row(inputs, sab))

    graph = ingest.build_context(
        inputs.spark,
        tables.empty_graph(inputs.spark),
        [("CUST", load("fx_customer_edges", "fx_customer_nodes", "CUST")), ("ORD", load("fx_order_edges", "fx_order_nodes", "ORD"))],
        shared_folder(inputs.spark, "context"),
    )
    return graph.coderels.select("start_id", "codeid", "tty")


# ---- concepts that change ----------------------------------------------------------------

VIEWS["fx_new_links"] = """
SELECT concat('PART:', CAST(p_partkey AS STRING)) AS codeid, concat('UMLS:B', replace(p_brand, 'Brand#', '')) AS start_id FROM part
UNION ALL SELECT concat('PART:', CAST(p_partkey AS STRING)), concat('UMLS:T', p_type) FROM part"""
VIEWS["fx_part_rels"] = """
SELECT CASE l_returnflag WHEN 'A' THEN 'sold_with' ELSE 'part_of' END AS label, concat('PART:', CAST(l_partkey AS STRING)) AS start_id,
       concat('PART:', CAST(l_suppkey AS STRING)) AS end_id, 'PART' AS sab FROM lineitem"""


@query("cui_changes", """
SELECT o.start_id AS old_cui, n.start_id AS new_cui, n.codeid FROM fx_new_links n JOIN fx_coderels o ON n.codeid = o.codeid
""")
def cui_changes(inputs: Inputs) -> DataFrame:
    return ingest.changed_concepts(inputs.view("fx_new_links"), base_coderels(inputs))


@query("cui_rewrite", """
WITH m AS (SELECT DISTINCT o.start_id AS old_cui, n.start_id AS new_cui FROM fx_new_links n JOIN fx_coderels o ON n.codeid = o.codeid WHERE o.start_id = o.codeid)
SELECT label, coalesce(s.new_cui, start_id) AS start_id, coalesce(e.new_cui, end_id) AS end_id FROM fx_part_rels r
LEFT JOIN m e ON r.end_id = e.old_cui LEFT JOIN m s ON r.start_id = s.old_cui
UNION ALL SELECT 'CODE', start_id, end_id FROM fx_coderels WHERE start_id NOT IN (SELECT old_cui FROM m)
""")
def cui_rewrite(inputs: Inputs) -> DataFrame:
    changes = ingest.changed_concepts(inputs.view("fx_new_links"), base_coderels(inputs))
    rels, coderels = ingest.rewrite_changed(inputs.view("fx_part_rels"), base_coderels(inputs), changes)
    return rels.select("label", "start_id", "end_id").unionByName(coderels.select(F.lit("CODE").alias("label"), "start_id", "end_id"))


# three sources: orders name customers and their accounts, then both bring cross-references of their own
VIEWS["fx_account_nodes"] = """
SELECT concat('ACC:', CAST(c_custkey AS STRING)) AS node_id, concat('account ', CAST(c_custkey AS STRING)) AS node_label, '' AS node_definition, '' AS node_synonyms,
       CASE WHEN c_mktsegment = 'BUILDING' THEN concat('umls:c7', lpad(CAST(c_custkey AS STRING), 9, '0')) ELSE '' END AS node_dbxrefs, c_custkey AS ord FROM customer"""
VIEWS["fx_account_edges"] = """
SELECT concat('ACC:', CAST(c_custkey AS STRING)) AS subject, 'kept_in' AS predicate, concat('NATION:', CAST(c_nationkey AS STRING)) AS object, c_custkey AS ord FROM customer"""
VIEWS["fx_holder_nodes"] = """
SELECT concat('CUST:', CAST(c_custkey AS STRING)) AS node_id, c_name AS node_label, '' AS node_definition, '' AS node_synonyms,
       concat('acc:', CAST(c_custkey AS STRING)) AS node_dbxrefs, c_custkey AS ord FROM customer"""
VIEWS["fx_buyer_nodes"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS node_id, o_orderpriority AS node_label, '' AS node_definition, '' AS node_synonyms, '' AS node_dbxrefs, o_orderkey AS ord FROM orders"""
VIEWS["fx_buyer_edges"] = """
SELECT * FROM fx_order_edges UNION ALL
SELECT concat('CUST:', CAST(c_custkey AS STRING)), 'has_account', concat('ACC:', CAST(c_custkey AS STRING)), 100000000000 + c_custkey FROM customer"""


@query("context_moved_concepts", """
WITH c AS (SELECT c_custkey, c_nationkey, concat('ACC:', CAST(c_custkey AS STRING)) AS acc, concat('CUST:', CAST(c_custkey AS STRING)) AS code,
  CASE WHEN c_mktsegment = 'BUILDING' THEN concat('UMLS:C7', lpad(CAST(c_custkey AS STRING), 9, '0')) ELSE concat('ACC:', CAST(c_custkey AS STRING)) END AS cui FROM customer)
SELECT 'placed_by' AS label, concat('ORD:', CAST(o_orderkey AS STRING)) AS start_id, cui AS end_id, 1 AS step FROM orders JOIN c ON o_custkey = c_custkey
UNION ALL SELECT 'has_account', cui, cui, 1 FROM c
UNION ALL SELECT 'located_in', cui, concat('NATION:', CAST(c_nationkey AS STRING)), 2 FROM c
UNION ALL SELECT 'kept_in', cui, concat('NATION:', CAST(c_nationkey AS STRING)), 3 FROM c
UNION ALL SELECT 'CODE', concat('ORD:', CAST(o_orderkey AS STRING)), concat('ORD:', CAST(o_orderkey AS STRING)), 1 FROM orders
UNION ALL SELECT 'CODE', code, cui, 2 FROM c
UNION ALL SELECT 'CODE', acc, cui, 3 FROM c
UNION ALL SELECT 'CODE', acc, acc, 1 FROM c WHERE acc = cui
UNION ALL SELECT DISTINCT 'CODE', concat('NATION:', CAST(c_nationkey AS STRING)), concat('NATION:', CAST(c_nationkey AS STRING)), s FROM c, (SELECT unnest([2, 3]) AS s)
UNION ALL SELECT 'CONCEPT', cui, cui, CASE WHEN cui = acc THEN 1 ELSE 3 END FROM c
UNION ALL SELECT 'CONCEPT', concat('ORD:', CAST(o_orderkey AS STRING)), concat('ORD:', CAST(o_orderkey AS STRING)), 1 FROM orders
UNION ALL SELECT DISTINCT 'CONCEPT', concat('NATION:', CAST(c_nationkey AS STRING)), concat('NATION:', CAST(c_nationkey AS STRING)), 2 FROM c
""")
def context_moved_concepts(inputs: Inputs) -> DataFrame:
    def load(edges: str, nodes: str, sab: str):
        return lambda: (inputs.view(edges), tables.list_columns(inputs.view(nodes)), source_row(inputs, sab))

    sources = [
        ("ORD", load("fx_buyer_edges", "fx_buyer_nodes", "ORD")),
        ("CUST", load("fx_customer_edges", "fx_holder_nodes", "CUST")),
        ("ACC", load("fx_account_edges", "fx_account_nodes", "ACC")),
    ]
    folder = shared_folder(inputs.spark, "context")
    graph = ingest.build_context(inputs.spark, tables.empty_graph(inputs.spark), sources, folder, move_concepts=True)
    rels = graph.rels.select("label", "start_id", "end_id", "step")
    codes = graph.coderels.select(F.lit("CODE").alias("label"), F.col("codeid").alias("start_id"), F.col("start_id").alias("end_id"), "step")
    concepts = graph.concepts.select(F.lit("CONCEPT").alias("label"), F.col("id").alias("start_id"), F.col("id").alias("end_id"), "step")
    return rels.unionByName(codes).unionByName(concepts)


# ---- sequence numbers --------------------------------------------------------------------


@query("sequence_ids", """
WITH f AS (SELECT o_custkey, min(o_orderkey) AS first_ord FROM orders GROUP BY o_custkey)
SELECT o_custkey, concat('CUST:', CAST(1000 + row_number() OVER (ORDER BY first_ord, o_custkey) AS STRING)) AS node_id FROM f
""")
def sequence_ids(inputs: Inputs) -> DataFrame:
    firsts = inputs.table("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_ord"))
    numbered = dense_number(firsts, ["first_ord", "o_custkey"], "n")
    return numbered.select("o_custkey", padded_id(F.col("n") + 1000, "CUST").alias("node_id"))


# ---- questions ---------------------------------------------------------------------------


@query("codes_of_concept", "SELECT DISTINCT start_id AS cui, codeid FROM fx_coderels WHERE codeid LIKE 'PART:%'")
def codes_of_concept(inputs: Inputs) -> DataFrame:
    return ask.codes_of_concept(base_coderels(inputs), inputs.view("fx_concepts").select(F.col("id").alias("cui")), "PART")


@query("codes_of_term", "SELECT DISTINCT end_id AS term, codeid FROM fx_coderels WHERE tty = 'PT'")
def codes_of_term(inputs: Inputs) -> DataFrame:
    return ask.codes_of_term(base_coderels(inputs), inputs.view("fx_terms").select(F.col("id").alias("term")), "PART")


VIEWS["fx_asked_codes"] = """
SELECT CASE WHEN l_linestatus = 'O' THEN concat('PART:', CAST(l_partkey AS STRING)) ELSE concat('SUPP:', CAST(l_suppkey AS STRING)) END AS codeid FROM lineitem"""


@query("concepts_of_code", "SELECT DISTINCT c.codeid, c.start_id AS cui FROM fx_coderels c JOIN fx_asked_codes a ON a.codeid = c.codeid")
def concepts_of_code(inputs: Inputs) -> DataFrame:
    return ask.concepts_of_code(base_coderels(inputs), inputs.view("fx_asked_codes"))


@query("equivalence_classes", """
SELECT start_id AS cui, row_number() OVER (PARTITION BY start_id ORDER BY codeid) AS pos, codeid FROM (SELECT DISTINCT start_id, codeid FROM fx_coderels)
""")
def equivalence_classes(inputs: Inputs) -> DataFrame:
    return ask.equivalence_classes(base_coderels(inputs))


VIEWS["fx_rels"] = "SELECT predicate AS label, subject AS start_id, object AS end_id, 'ORD' AS sab FROM fx_edges"
VIEWS["fx_regions"] = "SELECT concat('REGION:', CAST(r_regionkey AS STRING)) AS cui FROM region"


@query("path_expand", """
WITH RECURSIVE hops AS (SELECT DISTINCT end_id AS src, start_id AS dst FROM fx_rels WHERE label IN ('http://purl.obolibrary.org/obo/x#placed_by', 'located in', 'part_of')),
walk(start, cui, depth) AS (SELECT cui, cui, 0 FROM fx_regions UNION SELECT start, dst, depth + 1 FROM walk JOIN hops ON walk.cui = hops.src WHERE depth < 3)
SELECT start, cui, min(depth) AS depth FROM walk GROUP BY start, cui HAVING min(depth) BETWEEN 1 AND 3
""")
def path_expand(inputs: Inputs) -> DataFrame:
    labels = ["http://purl.obolibrary.org/obo/x#placed_by", "located in", "part_of"]
    return ask.path_expand(inputs.view("fx_rels"), inputs.view("fx_regions"), labels, "ORD", 1, 3, reverse=True)


VIEWS["fx_turns"] = """
SELECT 'followed_by' AS label, concat('TURN:', CAST(a.conv_id AS STRING), '.', CAST(a.turn AS STRING)) AS start_id,
       concat('TURN:', CAST(b.conv_id AS STRING), '.', CAST(b.turn AS STRING)) AS end_id, 'CONV' AS sab
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"""
VIEWS["fx_first_turns"] = """
SELECT concat('TURN:', CAST(conv_id AS STRING), '.', CAST(min(turn) AS STRING)) AS cui FROM conversations GROUP BY conv_id"""


@query("longest_path", """
WITH RECURSIVE walk(start, cui, hops, path) AS (SELECT cui, cui, 0, cui FROM fx_first_turns
  UNION ALL SELECT start, end_id, hops + 1, concat(path, '>', end_id) FROM walk JOIN (SELECT DISTINCT start_id, end_id FROM fx_turns) t ON walk.cui = t.start_id WHERE hops < 9)
SELECT start, cui, hops, path FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY hops DESC, path) AS rn FROM walk WHERE hops > 0) WHERE rn = 1
""")
def longest_path(inputs: Inputs) -> DataFrame:
    return ask.longest_paths(inputs.view("fx_turns"), inputs.view("fx_first_turns"), ["followed_by"], 9)


VIEWS["fx_order_concepts"] = """
SELECT CASE l_linestatus WHEN 'O' THEN 'contains' ELSE 'view' END AS label, concat('ORD:', CAST(l_orderkey AS STRING)) AS start_id, c.start_id AS end_id, 'ORD' AS sab
FROM lineitem JOIN fx_coderels c ON c.codeid = concat('PART:', CAST(l_partkey AS STRING))"""


@query("pattern_match", """
SELECT DISTINCT r.start_id, r.end_id, c.codeid, c.end_id AS term FROM fx_order_concepts r JOIN fx_coderels c ON r.end_id = c.start_id WHERE r.label = 'contains'
""")
def pattern_match(inputs: Inputs) -> DataFrame:
    return ask.pattern_match(inputs.view("fx_order_concepts"), base_coderels(inputs), "contains", "PART")
