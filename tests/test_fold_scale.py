"""Folding a source sorts, joins and numbers its rows no more often than it must."""

from pyspark.sql import functions as F

from vocabweave.operators import keyed, resolve
from vocabweave.plans import ingest

NODE = "node_id string, node_label string, node_definition string, node_synonyms array<string>, node_dbxrefs array<string>, ord long"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def nodes_of(spark, *rows):
    return spark.createDataFrame([(n, f"label {n}", "d", synonyms, [""], i) for i, (n, synonyms) in enumerate(rows)], NODE)


def test_a_node_meets_its_concepts_once_for_all_its_terms(spark):
    nodes = nodes_of(spark, ("A:1", ["s", "", None, "t"]), ("A:2", None), ("UMLS:C1", ["u"]), (None, ["v"])).withColumn("unit", F.lit("kg"))
    listed = spark.createDataFrame([("A:1", "C1", 1), ("A:1", "C2", 2), ("A:2", "C3", 1), ("UMLS:C1", "C4", 1), (None, "C5", 1)], "node_id string, cui string, pos long")
    links = ingest.build_coderels(nodes, listed, "A")
    assert optimized(links).count("Join") == 1
    got = sorted((r.start_id, r.end_id, r["def"], r.codeid, r.tty, tuple(r.props.items())) for r in links.collect())
    unit = (("unit", "kg"),)
    assert got == sorted(
        [(c, e, d, "A:1", t, unit) for c in ("C1", "C2") for e, d, t in (("label A:1", "d", "PT"), ("s", "", "SY"), ("t", "", "SY"))]
        + [("C3", "label A:2", "d", "A:2", "PT", unit)]
    )
    rows = spark.createDataFrame([("A:2", "x/y"), ("A:2", ""), ("A:9", "z"), ("UMLS:C1", "w")], "node_id string, synonym string")
    more = ingest.build_coderels(nodes, listed, "A", rows).where("codeid = 'A:2'").select("start_id", "end_id", "tty")
    assert sorted(map(tuple, more.collect())) == [("C3", "label A:2", "PT"), ("C3", "x_y", "SY")]


def test_properties_of_an_edge_become_a_map_behind_the_joins(spark):
    edges = spark.createDataFrame([("a", "p", "b", 1, "x", "s"), ("a", "q", "c", 2, None, "t"), ("a", "q", "z", 3, "u", "u")], "subject string, predicate string, object string, ord long, evidence_class string, start_id string")
    assigned = spark.createDataFrame([(c, c.upper()) for c in "abc"], "node_id string, assigned_cui string")
    rels = ingest.edges_to_rels(edges, assigned, "S")
    assert "map(" not in optimized(rels.select("label", F.col("props")["evidence_class"]))
    assert sorted((r.label, r.start_id, r.end_id, tuple(sorted(r.props.items()))) for r in rels.collect()) == [
        ("p", "A", "B", (("evidence_class", "x"), ("start_id", "s"))), ("q", "A", "C", (("evidence_class", ""), ("start_id", "t")))]


def test_endpoints_are_not_sorted_among_the_node_rows(spark):
    edges = spark.createDataFrame([("A:1", "A:3"), ("A:1", None), (None, "A:1")], "subject string, object string")
    nodes = nodes_of(spark, ("A:1", ["s"]), ("A:1", ["later"]), ("A:2", [""]))
    whole = resolve.complete_nodes(edges, nodes)
    below = optimized(whole).split("Window [", 1)[1].split("Join LeftAnti", 1)[0]
    assert "Union" not in below
    ids = lambda df: sorted(((r.node_id, r.node_label, r.ord) for r in df.collect()), key=str)
    assert ids(whole) == sorted([("A:1", "label A:1", 0), ("A:2", "label A:2", 2), ("A:3", "A:3", 2**62), (None, "", 2**62)], key=str)
    known = nodes.unionByName(nodes_of(spark, (None, ["n"])).withColumn("ord", F.lit(9).cast("long")))
    assert (None, "label None", 9) in ids(resolve.complete_nodes(edges, known)) and len(ids(resolve.complete_nodes(edges, known))) == 4


def assigned_lists(spark, mode):
    nodes = nodes_of(spark, *[(n, [""]) for n in ("N:1", "N:2", "N:3", "P:1", None)])
    links = spark.createDataFrame([("UMLS:U1", "P:1", 0, 1, 0), ("P:1", "P:1", 0, 2, 0), ("P:2", "P:2", 0, 3, 0)], "start_id string, codeid string, step int, ord long, pos long")
    xrefs = spark.createDataFrame([("N:1", 0, "P:1"), ("N:2", 0, "P:1"), ("N:2", 1, "P:2"), ("N:2", 2, "P:2"), (None, 0, "P:2")], "node_id string, xref_ord long, xref string")
    assigned, listed = resolve.assign_concepts(nodes, links, mode, xrefs)
    assert assigned.columns == ["node_id", "rank", "first_cui", "assigned_cui", "assignment_comment"]
    return {r.node_id: r.assigned_cui for r in assigned.collect()}, sorted(map(tuple, listed.collect()), key=str)


def test_lists_are_numbered_once_and_serve_the_choice(spark, monkeypatch):
    calls = []
    real = resolve.concept_rows
    monkeypatch.setattr(resolve, "concept_rows", lambda *given: calls.append(given) or real(*given))
    picks, listed = assigned_lists(spark, "own_code")
    assert len(calls) == 1
    assert picks == {"N:1": "N:1", "N:2": "N:2", "N:3": "N:3", "P:1": "P:1", None: None}
    assert listed == sorted([
        ("N:1", "UMLS:U1", 2, 1), ("N:1", "P:1", 3, 2), ("N:1", "N:1", 6, 3), ("N:2", "UMLS:U1", 2, 1), ("N:2", "P:1", 3, 2), ("N:2", "P:2", 3, 3),
        ("N:2", "N:2", 6, 4), ("N:3", "N:3", 6, 1), ("P:1", "UMLS:U1", 4, 1), ("P:1", "P:1", 6, 2), (None, "P:2", 3, 1), (None, None, 6, 2)], key=str)
    calls.clear()
    greedy = assigned_lists(spark, "greedy")
    assert len(calls) == 1 and greedy[0] == {"N:1": "UMLS:U1", "N:2": "P:1", "N:3": "N:3", "P:1": "P:1", None: None}
    monkeypatch.setattr(keyed, "MIN_HOT_ROWS", 2)
    monkeypatch.setattr(keyed, "SHARES", 10**9)
    assert (picks, listed) == assigned_lists(spark, "own_code") and greedy == assigned_lists(spark, "greedy")


def test_a_side_is_hashed_only_where_its_shares_are_small(spark, monkeypatch):
    side = spark.range(100)
    hinted = lambda: "shuffle_hash" in keyed.hashed_side(side)._jdf.queryExecution().logical().toString().lower()
    seen = []
    for rows in (100, 50, 10):
        monkeypatch.setattr(keyed, "TASK_ROWS", rows)
        seen.append(hinted())
    # the session has four shuffle partitions
    assert seen == [False, True, False]
