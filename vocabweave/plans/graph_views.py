"""Views that give the tables the shape of a graph and a source to fold into it."""

from vocabweave.plans.catalog import VIEWS

# the graph that already exists: every part is a code, small parts share UMLS concepts
VIEWS["fx_coderels"] = """
SELECT CASE WHEN p_size <= 20 THEN concat('UMLS:C9', lpad(CAST(p_size AS STRING), 3, '0'), replace(p_brand, 'Brand#', ''))
            ELSE concat('PART:', CAST(p_partkey AS STRING)) END AS start_id,
       p_name AS end_id, 'PART' AS sab, '' AS def, concat('PART:', CAST(p_partkey AS STRING)) AS codeid, 'PT' AS tty,
       p_partkey AS ord
FROM part"""

# nodes of the new source: all orders, and all parts as codes that the graph knows
VIEWS["fx_nodes"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS node_id, concat(o_orderpriority, ' ', CAST(o_custkey AS STRING)) AS node_label,
       concat('order of customer ', CAST(o_custkey AS STRING)) AS node_definition,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('status ', o_orderstatus, '|cust/', CAST(o_custkey AS STRING)) END AS node_synonyms,
       o_orderpriority AS unit, o_custkey AS value, o_orderkey AS ord FROM orders
UNION ALL
SELECT concat('PART:', CAST(p_partkey AS STRING)), p_name, '', p_brand, p_type, CAST(NULL AS BIGINT), 1000000000000 + p_partkey FROM part"""

# cross-references of the new source: UMLS concepts of its own, shared ones, parts in two spellings, unknown codes
VIEWS["fx_xrefs"] = """
SELECT concat('ORD:', CAST(l_orderkey AS STRING)) AS node_id, CAST(l_linenumber AS BIGINT) AS xref_ord,
       CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN concat('umls:c', lpad(CAST(l_orderkey AS STRING), 9, '0'))
            WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN concat('umls:c9', lpad(CAST(l_suppkey AS STRING), 9, '0'))
            WHEN l_linenumber IN (3, 4) AND l_linestatus = 'F' THEN concat('part:', CAST(l_partkey AS STRING))
            WHEN l_linenumber IN (3, 4) THEN concat('PART_', CAST(l_partkey AS STRING))
            ELSE concat('supp:', CAST(l_suppkey AS STRING)) END AS dbxref
FROM lineitem"""

# edges of the new source; customers, nations and regions have no node row
VIEWS["fx_edges"] = """
SELECT concat('ORD:', CAST(o_orderkey AS STRING)) AS subject, 'http://purl.obolibrary.org/obo/x#placed_by' AS predicate,
       concat('CUST:', CAST(o_custkey AS STRING)) AS object, o_orderstatus AS evidence_class, o_orderkey AS ord FROM orders
UNION ALL SELECT concat('CUST:', CAST(c_custkey AS STRING)), 'located in', concat('NATION:', CAST(c_nationkey AS STRING)), '',
       10000000000 + c_custkey FROM customer
UNION ALL SELECT concat('NATION:', CAST(n_nationkey AS STRING)), 'part_of', concat('REGION:', CAST(n_regionkey AS STRING)), '',
       20000000000 + n_nationkey FROM nation
UNION ALL SELECT concat('ORD:', CAST(l_orderkey AS STRING)), CASE WHEN l_linestatus = 'O' THEN 'contains' ELSE 'view' END,
       concat('PART:', CAST(l_partkey AS STRING)), l_returnflag, 30000000000 + l_orderkey * 10 + l_linenumber FROM lineitem"""

VIEWS["fx_rel_labels"] = """
SELECT concat('UMLS:', event_type) AS id, event_type AS rel_label, event_type AS def, 'UMLS' AS sab, min(event_id) AS ord FROM events GROUP BY event_type"""

VIEWS["fx_terms"] = "SELECT p_name AS id, min(p_partkey) AS ord FROM part GROUP BY p_name"

VIEWS["fx_concepts"] = """
SELECT start_id AS id, min(end_id) AS pref_term, 'PART' AS sab, min(ord) AS ord FROM fx_coderels GROUP BY start_id"""

# the same steps in SQL, for the comparison
VIEWS["ox_missing"] = """
SELECT DISTINCT node_id FROM (SELECT subject AS node_id FROM fx_edges UNION ALL SELECT object FROM fx_edges) e
WHERE node_id NOT IN (SELECT node_id FROM fx_nodes)"""

VIEWS["ox_nodes"] = """
SELECT node_id, node_label, node_definition, regexp_replace(node_synonyms, '[^A-Za-z0-9._ |]', '_', 'g') AS node_synonyms, unit,
       coalesce(CAST(value AS STRING), '') AS value, ord FROM fx_nodes
UNION ALL SELECT node_id, node_id, '', '', '', '', 4611686018427387904 FROM ox_missing"""

VIEWS["ox_xstd"] = """
SELECT node_id, xref_ord, CASE WHEN dbxref LIKE 'umls:%' THEN concat('UMLS:', substr(dbxref, 6))
       WHEN dbxref LIKE 'supp:%' THEN concat('SUPP:', substr(dbxref, 6)) ELSE concat('PART:', substr(dbxref, 6)) END AS xref FROM fx_xrefs"""

VIEWS["ox_candidates"] = """
SELECT node_id, 1 AS rnk, xref_ord, 0 AS cord, upper(xref) AS cui FROM ox_xstd WHERE xref LIKE 'UMLS:%'
UNION ALL SELECT node_id, CASE WHEN start_id LIKE 'UMLS%' THEN 2 ELSE 3 END, xref_ord, c.ord, start_id
          FROM ox_xstd x JOIN fx_coderels c ON x.xref = c.codeid
UNION ALL SELECT node_id, 4, 0, c.ord, c.start_id FROM ox_nodes n JOIN fx_coderels c ON n.node_id = c.codeid"""

VIEWS["ox_choice"] = """
SELECT n.node_id, coalesce(c.rnk, 5) AS rnk, coalesce(c.cui, n.node_id) AS cui FROM ox_nodes n LEFT JOIN
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY rnk, xref_ord, cord, cui) AS rn FROM ox_candidates) WHERE rn = 1) c
  ON n.node_id = c.node_id"""

VIEWS["ox_assigned"] = """
SELECT node_id, rnk, cui AS first_cui, CASE WHEN count(*) OVER (PARTITION BY cui) > 1 THEN node_id ELSE cui END AS assigned_cui FROM ox_choice"""

VIEWS["ox_lists"] = """
SELECT node_id, cui, row_number() OVER (PARTITION BY node_id ORDER BY rnk, xref_ord, cord, cui) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY node_id, cui ORDER BY rnk, xref_ord, cord) AS k FROM (
    SELECT * FROM ox_candidates UNION ALL SELECT node_id, 6, 0, 0, assigned_cui FROM ox_assigned)) WHERE k = 1"""

VIEWS["ox_coderels"] = """
SELECT l.cui AS start_id, n.node_label AS end_id, 'ORD' AS sab, n.node_definition AS def, n.node_id AS codeid, 'PT' AS tty, unit
FROM ox_lists l JOIN ox_nodes n ON l.node_id = n.node_id WHERE n.node_id NOT LIKE 'UMLS:%'
UNION ALL
SELECT l.cui, s.syn, 'ORD', '', n.node_id, 'SY', unit FROM ox_lists l JOIN ox_nodes n ON l.node_id = n.node_id
JOIN (SELECT node_id AS sid, unnest(string_split(node_synonyms, '|')) AS syn FROM ox_nodes) s ON s.sid = n.node_id
WHERE n.node_id NOT LIKE 'UMLS:%' AND s.syn <> ''"""

VIEWS["ox_rels"] = """
SELECT e.predicate AS label, s.assigned_cui AS start_id, o.assigned_cui AS end_id, 'ORD' AS sab, evidence_class
FROM fx_edges e JOIN ox_assigned s ON e.subject = s.node_id JOIN ox_assigned o ON e.object = o.node_id"""
