"""Concept choice, ingest and table IO."""

import csv
import dataclasses
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vocabweave.operators import quality, resolve
from vocabweave.operators.chains import chain_ends
from vocabweave.plans import ingest
from vocabweave.sources import field_vocabulary, known, sheets, tables

NODE = "node_id string, node_label string, node_definition string, node_synonyms array<string>, node_dbxrefs array<string>, ord bigint"


def nodes_of(spark, rows):
    return spark.createDataFrame([(n, f"label {n}", "", [""], x, i) for i, (n, x) in enumerate(rows)], NODE)


def links(spark, rows):
    return spark.createDataFrame(
        [(c, "term", "P", "", k, "PT", {}, 0, i, 0) for i, (c, k) in enumerate(rows)], tables.GRAPH_SCHEMAS["coderels"]
    )


def assigned(spark, rows, coderels=(), mode="own_code"):
    nodes = nodes_of(spark, rows)
    table, listed = resolve.assign_concepts(nodes, links(spark, list(coderels)), mode)
    lists = {}
    for row in sorted(listed.collect(), key=lambda r: r.pos):
        lists.setdefault(row.node_id, []).append(row.cui)
    return {r.node_id: r.assigned_cui for r in table.collect()}, lists


def test_rank_order(spark):
    coderels = [("UMLS:C1", "FMA:1"), ("CL:2", "CL:2"), ("N:4", "N:4"), ("UMLS:C9", "N:5")]
    rows = [
        ("N:1", ["cl:2", "fma:1", "umls:c7"]), ("N:2", ["cl:2", "fma:1"]), ("N:3", ["cl:2"]), ("N:4", [""]), ("N:6", ["zz:1"]),
    ]
    picked, lists = assigned(spark, rows, coderels)
    assert lists["N:1"] == ["UMLS:C7", "UMLS:C1", "CL:2"]
    assert picked == {"N:1": "UMLS:C7", "N:2": "UMLS:C1", "N:3": "CL:2", "N:4": "N:4", "N:6": "N:6"}


def test_direct_concept_spelled_with_its_kind(spark):
    assert assigned(spark, [("DOID:1", ["umls_cui:x"])])[0] == {"DOID:1": "UMLS:X"}


def test_shared_goes_to_nobody(spark):
    for rows in ([("U:1", ["umls:a"]), ("U:2", ["umls:a", "umls:b"])], [("U:2", ["umls:a", "umls:b"]), ("U:1", ["umls:a"])]):
        picked, lists = assigned(spark, rows)
        assert picked == {"U:1": "U:1", "U:2": "U:2"}
        assert lists["U:2"] == ["UMLS:A", "UMLS:B", "U:2"]


def test_shared_greedy(spark):
    picked, _ = assigned(spark, [("U:1", ["umls:a"]), ("U:2", ["umls:a", "umls:b"])], mode="greedy")
    assert picked == {"U:1": "UMLS:A", "U:2": "UMLS:B"}
    picked, _ = assigned(spark, [("U:2", ["umls:a", "umls:b"]), ("U:1", ["umls:a"])], mode="greedy")
    assert picked == {"U:2": "UMLS:A", "U:1": "U:1"}


def walk(rows):
    """The greedy walk, group by group, in node order."""
    first = {}
    for node, xrefs in rows:
        own = list(dict.fromkeys(f"UMLS:{x.split(':')[1].upper()}" for x in xrefs)) or [node]
        first.setdefault(own[0], []).append((node, own))
    picked = {}
    for members in first.values():
        taken = set()
        for node, own in members:
            choice = own[0] if len(members) == 1 else next((c for c in own if c not in taken), node)
            taken.add(choice)
            picked[node] = choice
    return picked


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    rows = [(f"U:{i}", [f"umls:{rng.choice('abcdefgh')}" for _ in range(rng.randint(1, 5))]) for i in range(40)]
    picked, _ = assigned(spark, rows, mode="greedy")
    assert picked == walk(rows)


@pytest.mark.parametrize("group_rows", [0, 20, 10**6])
def test_greedy_by_rounds_and_by_walks(spark, group_rows, monkeypatch):
    """All by rounds, first by rounds and then by walks, and all by walks."""
    rng = random.Random(3)
    rows = [(f"U:{i:02}", [f"umls:{rng.choice('ab')}", *(f"umls:{rng.choice('abcdefgh')}" for _ in range(rng.randint(0, 4)))]) for i in range(40)]
    monkeypatch.setattr(resolve.resolve_shared_greedy, "__defaults__", (group_rows,))
    picked, _ = assigned(spark, rows, mode="greedy")
    assert picked == walk(rows)


def test_a_long_chain_of_shared_concepts_takes_few_rounds(spark, monkeypatch):
    """Each node pushes the next one on; by rounds alone this would take 2,000 of them."""
    rows = [("U:0000", ["umls:a"]), ("U:0001", ["umls:a", "umls:c1"])]
    rows += [(f"U:{i:04}", ["umls:a", f"umls:c{i - 1}", f"umls:c{i}"]) for i in range(2, 2000)]
    rounds = []
    one_round = resolve._offers_round
    monkeypatch.setattr(resolve, "_offers_round", lambda offers: rounds.append(1) or one_round(offers))
    picked, _ = assigned(spark, rows, mode="greedy")
    assert picked == walk(rows)
    assert len(rounds) < 30


def source(spark, sab):
    return spark.createDataFrame([(f"{sab}:{sab}", sab, "", sab, "1", "", None, ["PT", "SY"])],
                                 "id string, name string, description string, sab string, source_version string, source string, srl int, ttyl array<string>")


def edges_of(spark, rows):
    return spark.createDataFrame([(s, p, o, "x", i) for i, (s, p, o) in enumerate(rows)], "subject string, predicate string, object string, evidence string, ord bigint")


@pytest.fixture(scope="module")
def small(spark):
    nodes = spark.createDataFrame(
        [("A:1", "one", "d1", ["uno", "ein-s"], ["umls:c1"], 0), ("A:2", "two", "", [""], [""], 1), ("A:2", "again", "", [""], [""], 2), ("A:3", "three", "", ["one"], ["umls:c2"], 3)], NODE)
    edges = edges_of(spark, [("A:1", "part_of", "A:2"), ("A:2", "part_of", "B:9"), ("A:3", "is_a", "A:3")])
    return ingest.ingest_source(tables.empty_graph(spark), edges, nodes, source(spark, "A"), "A")


def test_ingest(small):
    graph = small.graph
    assert sorted((r.codeid, r.tty, r.start_id, r.end_id) for r in graph.coderels.collect()) == [
        ("A:1", "PT", "UMLS:C1", "one"), ("A:1", "SY", "UMLS:C1", "ein_s"), ("A:1", "SY", "UMLS:C1", "uno"),
        ("A:2", "PT", "A:2", "two"), ("A:3", "PT", "UMLS:C2", "three"), ("A:3", "SY", "UMLS:C2", "one"), ("B:9", "PT", "B:9", "B:9"),
    ]
    assert sorted((r.start_id, r.label, r.end_id, r.props["evidence"]) for r in graph.rels.collect()) == [
        ("A:2", "part_of", "B:9", "x"), ("UMLS:C1", "part_of", "A:2", "x"),
    ]
    assert [(r.start_id, r.label) for r in small.self_edges.collect()] == [("UMLS:C2", "is_a")]
    assert sorted(r.id for r in graph.terms.collect()) == ["B:9", "ein_s", "one", "three", "two", "uno"]
    assert sorted((r.id, r.pref_term) for r in graph.concepts.collect()) == [("A:2", "two"), ("B:9", "B:9"), ("UMLS:C1", "one"), ("UMLS:C2", "three")]
    assert [r.node_id for r in small.missing.collect()] == ["B:9"]


def test_own_output_passes_the_rules(small):
    counts = {r.rule: r.n_broken for r in quality.check_graph(small.graph.tables()).collect()}
    assert {rule for rule, n in counts.items() if n} == set()


def test_source_is_ingested_once(spark, small):
    with pytest.raises(ValueError, match="already"):
        ingest.ingest_source(small.graph, edges_of(spark, [("A:1", "p", "A:2")]), nodes_of(spark, [("A:1", [""])]), source(spark, "a"), "a")


def test_only_new_links(spark, small):
    again = ingest.ingest_source(
        small.graph, edges_of(spark, [("A:1", "p", "B:1")]), nodes_of(spark, [("A:1", [""]), ("B:1", ["a:2"])]), source(spark, "B"), "B", 2, only_new_links=True)
    new = {(r.codeid, r.start_id) for r in again.graph.coderels.where("step = 2").collect()}
    assert new == {("B:1", "A:2")}


def test_long_lists_reach_the_graph_once(spark):
    n = 20_000
    synonyms = spark.range(n).select(F.lit("A:1").alias("node_id"), F.concat(F.lit("syn "), "id").alias("synonym"))
    xrefs = spark.range(n).select(F.lit("A:1").alias("node_id"), F.col("id").alias("xref_ord"), F.concat(F.lit("UMLS:C"), "id").alias("xref"))
    nodes = nodes_of(spark, [("A:1", [""]), ("A:2", [""])]).drop("node_synonyms", "node_dbxrefs")
    done = ingest.ingest_source(
        tables.empty_graph(spark), edges_of(spark, [("A:1", "p", "A:2")]), nodes, source(spark, "A"), "A", xrefs=xrefs, synonyms=synonyms)
    assert done.graph.terms.where("id LIKE 'syn %'").agg(F.count("id"), F.count_distinct("id")).first() == (n, n)
    listed = done.concept_list.where("node_id = 'A:1'").agg(F.count("cui"), F.count_distinct("cui"), F.max("pos")).first()
    assert tuple(listed) in {(n, n, n), (n + 1, n + 1, n + 1)}
    links = done.graph.coderels.where("codeid = 'A:1'")
    assert links.where("tty = 'PT'").agg(F.count("start_id"), F.count_distinct("start_id")).first() == (listed[0], listed[0])


def test_ids_never_run_into_the_next_range(spark):
    table = spark.createDataFrame([(f"f{i}", f"v{i}", i) for i in range(1200)], "field string, value string, ord bigint")
    with pytest.raises(Exception, match="wider ranges"):
        field_vocabulary.encode_values(table, "field", "X").collect()
    wide = {kind: number * 10 for kind, number in field_vocabulary.PARENT_IDS.items()}
    assert field_vocabulary.encode_values(table, "field", "X", wide).select("node_id").distinct().count() == 1200


def test_text_that_begins_like_a_list(spark):
    rows = spark.createDataFrame([("f", "[deprecated] use x", 1), ("g", '["a", "b"]', 2), ("h", "plain", 3)], "field string, value string, ord bigint")
    assert sorted(r.value for r in field_vocabulary.field_values(rows).collect()) == ["[deprecated] use x", "a", "b", "plain"]


def test_own_sab_only(spark):
    nodes = nodes_of(spark, [("A:1", ["umls:c1"]), ("Z:1", ["umls:c2"])])
    done = ingest.ingest_source(tables.empty_graph(spark), edges_of(spark, [("A:1", "p", "Z:1")]), nodes, source(spark, "A"), "A", own_sab_only=True)
    assert {r.node_id: r.assigned_cui for r in done.assigned.collect()} == {"A:1": "UMLS:C1", "Z:1": "Z:1"}


def test_diagnostics(small, tmp_path, spark):
    small.write_diagnostics(str(tmp_path / "out"))
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out" / "missing_nodes")).count() == 1


def test_graph_round_trip(spark, small, tmp_path):
    tables.write_graph(small.graph, str(tmp_path / "graph"))
    back = tables.read_graph(spark, str(tmp_path / "graph" / "section=*"))
    for name in ("concepts", "terms", "rel_labels"):
        assert sorted(r.id for r in getattr(back, name).collect()) == sorted(r.id for r in getattr(small.graph, name).collect())
    flat = lambda g: sorted((r.start_id, r.end_id, r.codeid, r.tty, r["def"]) for r in g.coderels.collect())
    assert flat(back) == flat(small.graph)
    tables.write_graph(small.graph, str(tmp_path / "one"), ordered=True)
    assert spark.read.text(str(tmp_path / "one")).count() == sum(t.count() for t in small.graph.tables().values())


def test_unknown_kind_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"labels":["Planet"],"properties":{"id":"x"}}\n')
    with pytest.raises(PySparkException, match="unknown kind"):
        tables.read_graph(spark, str(tmp_path / "bad.json")).terms.collect()


def test_parquet_round_trip(spark, small, tmp_path):
    tables.save_graph(small.graph, str(tmp_path / "g"))
    assert tables.load_graph(spark, str(tmp_path / "g")).coderels.count() == small.graph.coderels.count()


def test_text_files(spark, tmp_path):
    import gzip

    (tmp_path / "nodes.tsv").write_text("node_id\tnode_label\tnode_dbxrefs\tunit\nA:1\tone\tx:1|y:2\tmm\nA:2\ttwo\t\t\n")
    with gzip.open(tmp_path / "edges.tsv.gz", "wt") as out:
        out.write("subject\tpredicate\tobject\nA:1\tp\tA:2\n")
    edges, nodes = tables.read_source(spark, str(tmp_path / "edges.tsv.gz"), str(tmp_path / "nodes.tsv"))
    assert [tuple(r)[:3] for r in edges.collect()] == [("A:1", "p", "A:2")]
    rows = nodes.orderBy("ord").collect()
    assert rows[0].node_dbxrefs == ["x:1", "y:2"] and rows[1].unit == "" and rows[1].node_synonyms == [""]
    assert tables.first_existing(spark, str(tmp_path), ["no.tsv", "nodes.tsv"]).endswith("nodes.tsv")


def test_counts_read_each_table_once(spark, small, tmp_path):
    tables.save_graph(small.graph, str(tmp_path / "g"))
    tables.save_graph(small.added, str(tmp_path / "a"))
    whole, added = tables.load_graph(spark, str(tmp_path / "g")), tables.load_graph(spark, str(tmp_path / "a"))
    grown = ingest.grown_counts(whole, added)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 * len(ingest.KINDS) == plan.count("ReadSchema: struct<>")
    rows = {r.node_type: (r.before, r.after) for r in grown.collect()}
    assert rows == {k: (getattr(whole, t).count(), getattr(whole, t).count() + getattr(added, t).count()) for k, t in ingest.KINDS.items()}
    assert {r.node_type: (r.after, r.after + rows[r.node_type][1] - rows[r.node_type][0]) for r in small.counts.collect()} == rows
    again = ingest.next_counts(small.counts, added)
    assert {tuple(r) for r in again.collect()} == {(k, *v) for k, v in rows.items()}


def test_many_tasks_read_what_one_gz_task_has_written(spark, tmp_path):
    import gzip

    rng = random.Random(4)
    with gzip.open(tmp_path / "a.tsv.gz", "wt", compresslevel=1) as out:
        out.write("k\tv\n")
        for i in range(300_000):
            out.write(f"{i}\t{rng.getrandbits(400):x}\n")
    table = tables.read_text_table(spark, str(tmp_path / "a.tsv.gz"))
    tasks = table.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first")).orderBy("first").collect()
    assert len(tasks) >= 3 and max(t.n for t in tasks) < 200_000
    assert table.where("CAST(k AS BIGINT) <> ord").isEmpty() and table.count() == 300_000


def test_gtf_and_skipped_header(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('##comment\nchr1\tsrc\tgene\t1\t9\t.\t+\t.\tgene_id "E.1"; level 2;\n')
    row = tables.read_gtf(spark, str(tmp_path / "a.gtf")).first()
    assert (row.chromosome_name, row.feature_type, row.column_9) == ("chr1", "gene", 'gene_id "E.1"; level 2;')
    (tmp_path / "x.csv").write_text("note\n" * 10 + "Organ_Level,Organ_ID\nL1,U:1\n")
    rows = tables.read_text_table(spark, str(tmp_path / "x.csv"), ",", skip_rows=10)
    assert [(r.Organ_Level, r.Organ_ID) for r in rows.collect()] == [("L1", "U:1")]


def test_rows_of_a_folder_keep_file_order(spark, tmp_path):
    """Large files come first in Spark's splits, but not in the order of rows."""
    (tmp_path / "many").mkdir()
    sizes = [3, 4000, 1, 900]
    for i, n in enumerate(sizes):
        (tmp_path / "many" / f"part-{i}.tsv").write_text("name\tn\n" + "".join(f"f{i}\t{k}\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = tables.read_text_table(spark, str(tmp_path / "many"), source_file="file").orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.name, int(r.n)) for r in rows] == [(f"f{i}", k) for i, n in enumerate(sizes) for k in range(n)]
    assert [r.ord for r in rows] == list(range(sum(sizes)))
    assert all(r.file.endswith(f"part-{r.name[1:]}.tsv") for r in rows)


def test_rows_are_skipped_in_every_file(spark, tmp_path):
    (tmp_path / "notes").mkdir()
    for name in "ab":
        (tmp_path / "notes" / f"{name}.csv").write_text(f"note one,\nnote two\nid,text\n{name}1,\"x, y\"\n#gone,z\n{name}2,w\n")
    rows = tables.read_text_table(spark, str(tmp_path / "notes"), ",", skip_rows=2, comment="#").orderBy("ord").collect()
    assert [(r.id, r.text) for r in rows] == [("a1", "x, y"), ("a2", "w"), ("b1", "x, y"), ("b2", "w")]


def test_ordered_graph_reads_back_with_the_same_ranks(spark, small, tmp_path):
    path = str(tmp_path / "ordered")
    tables.write_graph(small.graph, path, ordered=True)
    back = tables.read_graph(spark, path)
    ranked = lambda g: [(r.start_id, r.end_id, r.codeid, r.step, r.pos) for r in g.coderels.orderBy("step", "ord", "pos", "end_id").collect()]
    assert sorted(ranked(back)) == sorted(ranked(small.graph))
    firsts = lambda g: {r.codeid: r.first for r in g.coderels.groupBy("codeid").agg(F.min_by("start_id", F.struct("step", "ord", "pos")).alias("first")).collect()}
    assert firsts(back) == firsts(small.graph)
    tables.write_graph(back, path, ordered=True, overwrite=True)
    assert sorted(ranked(tables.read_graph(spark, path))) == sorted(ranked(small.graph))


def test_an_overwrite_that_stops_leaves_the_old_graph(spark, small, tmp_path, monkeypatch):
    path = str(tmp_path / "graph")
    ids = lambda g: sorted(r.id for r in g.terms.collect())
    tables.write_graph(small.graph, path)
    old = ids(tables.read_graph(spark, f"{path}/section=*"))
    fewer = dataclasses.replace(small.graph, terms=small.graph.terms.limit(1))

    def stop(*_):
        raise RuntimeError("stopped")

    for ordered in (False, True):
        with monkeypatch.context() as m:
            m.setattr(tables.versions, "publish", stop)
            with pytest.raises(RuntimeError, match="stopped"):
                tables.write_graph(fewer, path, ordered, overwrite=True)
        assert ids(tables.read_graph(spark, path)) == old
    for graph in (fewer, small.graph, fewer):
        tables.write_graph(graph, path, overwrite=True)
        assert ids(tables.read_graph(spark, path)) == ids(graph)
    assert len(list((tmp_path / "graph.versions").iterdir())) == 6
    tables.versions.remove_old(spark, path)
    assert len(list((tmp_path / "graph.versions").iterdir())) == 2 and not (tmp_path / "graph").exists()
    assert ids(tables.read_graph(spark, path)) == ids(fewer)


def test_first_rows(spark):
    """Against a sort of all rows; places repeat, steps are whole, cut or left out."""
    rows = [(step, place % 7, f"c{place * 37 % 11}", {"k": str(place % 3)}) for step in (None, 1, 4) for place in range(20)]
    table = spark.createDataFrame(rows, "step int, ord bigint, id string, props map<string,string>").repartition(5)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1], r[2], sorted(r[3].items())))
    for limit in (0, 1, 19, 20, 33, 40, 59, 60, 99):
        found = tables.first_rows(table, limit)
        assert "TakeOrderedAndProject" not in found._jdf.queryExecution().toString()
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, order[:limit])), limit


@pytest.mark.parametrize("split", ["400", "1000000"])
def test_quoted_line_breaks_over_splits(spark, tmp_path, split):
    """Against the csv module; cells hold line breaks, doubled quotes, separators, stray quotes and many lines."""
    cells = ["plain", "two\nlines", 'a "quoted" one', 'ends in a quote"', 'x,\n,"\n"', "", "#no comment\n#nor this", 'say ""\n""', "\n".join(f"line {i}, {chr(34)}" for i in range(40))]
    folder = tmp_path / "notes"
    folder.mkdir()
    expected = []
    for name in "ab":
        body = [[f"{name}{i}", cells[i * 5 % len(cells)], cells[i * 7 % len(cells)]] for i in range(60)]
        with open(folder / f"{name}.csv", "w", newline="") as out:
            out.write('an open " quote,"\nnote "two\n')
            csv.writer(out, lineterminator="\n").writerows([["id", "text", "more"], *body])
            out.write(f'#left, "out"\n{name}60,5" pipe,"x\ny"\n\n{name}61,a"b"c,""\n')
        expected += [*map(tuple, body), (f"{name}60", '5" pipe', "x\ny"), (f"{name}61", 'a"b"c', "")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = tables.read_text_table(spark, str(folder), ",", skip_rows=2, comment="#").orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.id, r.text, r.more) for r in rows] == expected


def test_a_quote_that_stays_open(spark, tmp_path):
    """Lines stand by themselves where a record would have too many of them."""
    (tmp_path / "x.csv").write_text('id,text\n1,"a\nb"\n2,"open\n' + "".join(f"{i},t\n" for i in range(3, 50)))
    lines = tables.in_file_order(tables._placed(spark.read.text(str(tmp_path / "x.csv"))).withColumn("_split", F.col("_block")), within="_line")
    found = [r.value for r in tables.quoted_records(lines, ",", '"', max_lines=10).orderBy("ord").collect()]
    assert found == ["id,text", '1,"a\nb"', '2,"open', *[f"{i},t" for i in range(3, 50)]]
    assert tables.read_text_table(spark, str(tmp_path / "x.csv"), ",", line_breaks=True).where("id = '1'").first().text == "a\nb"


def test_context_goes_on_after_the_last_finished_step(spark, tmp_path):
    folder, loaded = str(tmp_path / "context"), []

    def load(sab, fail=False):
        def run():
            loaded.append(sab)
            if fail:
                raise RuntimeError("stopped")
            return edges_of(spark, [(f"{sab}:1", "p", f"{sab}:2")]), nodes_of(spark, [(f"{sab}:1", ["a:1"]), (f"{sab}:2", [""])]), source(spark, sab)
        return run

    start = tables.empty_graph(spark)
    with pytest.raises(RuntimeError):
        ingest.build_context(spark, start, [("A", load("A")), ("B", load("B", fail=True))], folder)
    graph = ingest.build_context(spark, start, [("A", load("A")), ("B", load("B"))], folder)
    assert loaded == ["A", "B", "B"]
    assert {(r.codeid, r.step) for r in graph.coderels.collect()} == {("A:1", 1), ("A:2", 1), ("B:1", 2), ("B:2", 2)}
    assert {r.step for r in spark.read.parquet(f"{folder}/step=0002/coderels").collect()} == {2}
    counts = {r.node_type: (r.before, r.after) for r in spark.read.parquet(f"{folder}/step=0002/counts").collect()}
    assert counts["CODE rels"] == (2, 4) and counts["Source"] == (1, 2)


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "map.csv").write_text("﻿code,label\na,b\n")
    from vocabweave.operators.affixes import map_rows

    assert [tuple(r)[:2] for r in map_rows(tables.read_lookup(spark, str(tmp_path / "map.csv")), "code", "label").collect()] == [("a", "b")]


def test_registry(spark):
    text = '{"X": {"source_type": "owl", "name": "n", "description": "d", "version": "1", "owl_url": "u"}, "Y": {"source_type": "edge"}}'
    registry = tables.source_registry(spark.createDataFrame([(text,)], "value string"))
    row = tables.source_row(registry, "X").first()
    assert (row.id, row.source, row.ttyl) == ("X:X", "u", ["PT", "SY"])
    with pytest.raises(KeyError):
        tables.registry_entry(registry, "Z")


def test_changed_concepts(spark):
    old = links(spark, [("B:2", "B:2"), ("UMLS:C1", "B:3")])
    new = links(spark, [("UMLS:C5", "B:2"), ("UMLS:C6", "B:2"), ("UMLS:C7", "B:3")])
    rels = spark.createDataFrame([("r", "A:1", "B:2"), ("r", "B:2", "A:1"), ("r", "A:1", "B:3")], "label string, start_id string, end_id string")
    moved, kept = ingest.rewrite_changed(rels, old, ingest.changed_concepts(new, old))
    assert sorted((r.start_id, r.end_id) for r in moved.collect()) == [
        ("A:1", "B:3"), ("A:1", "UMLS:C5"), ("A:1", "UMLS:C6"), ("UMLS:C5", "A:1"), ("UMLS:C6", "A:1")]
    assert [r.start_id for r in kept.collect()] == ["UMLS:C1"]


def test_links_of_other_codes_move_along(spark):
    old = links(spark, [("B:2", "B:2"), ("B:2", "A:9"), ("UMLS:C1", "B:3")])
    moved = ingest.moved_concepts(ingest.changed_concepts(links(spark, [("UMLS:C5", "B:2")]), old))
    _, kept = ingest.rewrite_moved(spark.createDataFrame([], "start_id string, end_id string"), old, moved)
    assert sorted((r.start_id, r.codeid) for r in kept.collect()) == [("UMLS:C1", "B:3"), ("UMLS:C5", "A:9")]


def test_concepts_in_use_stay_and_chains_end(spark):
    pairs = [("A:1", "A:2"), ("A:2", "A:3"), ("A:3", "UMLS:C1"), ("A:3", "UMLS:C2"), ("B:1", "B:2"), ("B:2", "B:1"), ("B:3", "B:2"), ("D:1", "D:2")]
    changes = spark.createDataFrame([(o, n, o) for o, n in pairs] + [("UMLS:C9", "UMLS:C8", "Z:1")], "old_cui string, new_cui string, codeid string")
    used = spark.createDataFrame([("D:1",)], "assigned_cui string")
    assert sorted(map(tuple, ingest.moved_concepts(changes, used).collect())) == [
        *[(f"A:{i}", f"UMLS:C{k}") for i in (1, 2, 3) for k in (1, 2)], ("B:2", "B:1"), ("B:3", "B:1")]


def test_long_chains_end_in_few_joins(spark):
    chain = spark.range(1000).select(F.col("id").alias("old"), (F.col("id") + 1).alias("new"))
    assert chain_ends(chain, "old", "new").agg(F.count("*"), F.min("new"), F.max("new")).first() == (1000, 1000, 1000)
    ring = spark.range(5).select(F.col("id").alias("old"), ((F.col("id") + 1) % 5).alias("new"))
    assert chain_ends(ring, "old", "new").agg(F.count("*"), F.min("new"), F.max("new")).first() == (5, 0, 0)
    assert chain_ends(chain.limit(0), "old", "new").count() == 0


def test_moves_concern_earlier_steps_only(spark):
    """A concept that is minted again after it moved is another one for the rows of then."""
    moves = [(2, "A", "B"), (4, "B", "C"), (5, "A", "D"), (6, "C", "E"), (6, "C", "F")]
    found = ingest.moves_by_step(spark.createDataFrame(moves, "step int, old_cui string, new_cui string"))
    expected = [("A", "E", 0, 2), ("A", "F", 0, 2), ("A", "D", 2, 5), ("B", "E", 0, 4), ("B", "F", 0, 4), ("C", "E", 0, 6), ("C", "F", 0, 6)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    rels = spark.createDataFrame([("r", "A", "x", s) for s in (1, 2, 4, 5)], "label string, start_id string, end_id string, step int")
    codes = spark.createDataFrame([("A", "A", 1), ("A", "Q", 3)], "start_id string, codeid string, step int")
    links_, kept = ingest.rewrite_moved(rels, codes, found)
    assert sorted((r.step, r.start_id) for r in links_.collect()) == [(1, "E"), (1, "F"), (2, "D"), (4, "D"), (5, "A")]
    assert [(r.start_id, r.codeid) for r in kept.collect()] == [("D", "Q")]


def test_a_context_goes_on_with_its_moves(spark, tmp_path):
    made = lambda name: _moving_source(spark, name)
    sources = [("A", made("A")), ("B", made("B")), ("C", made("C"))]
    first = ingest.build_context(spark, tables.empty_graph(spark), sources[:2], str(tmp_path), move_concepts=True)
    assert {(r.start_id, r.end_id) for r in first.rels.where("label = 'says'").collect()} == {("A:1", "C:1")}
    before = (tmp_path / "step=0001/rels").stat().st_mtime
    whole = ingest.build_context(spark, tables.empty_graph(spark), sources, str(tmp_path), move_concepts=True)
    assert (tmp_path / "step=0001/rels").stat().st_mtime == before  # moved when read, not written again
    assert {(r.start_id, r.end_id) for r in whole.rels.where("label = 'says'").collect()} == {("A:1", "UMLS:C77")}
    assert {(r.codeid, r.start_id) for r in whole.coderels.collect()} == {("A:1", "A:1"), ("B:1", "UMLS:C77"), ("C:1", "UMLS:C77")}
    ids = [r.id for r in whole.concepts.collect()]
    assert sorted(ids) == ["A:1", "UMLS:C77"]
    changed = spark.read.csv(str(tmp_path / "step=0003/diagnostics/changed_concepts"), header=True)
    assert ("C:1", "UMLS:C77", "C:1") in {(r.old_cui, r.new_cui, r.codeid) for r in changed.collect()}


def _moving_source(spark, sab):
    """A names code B:1 and C:1; B refers its code to C:1, and C its own to a concept."""
    edges = {"A": [("A:1", "says", "B:1"), ("A:1", "knows", "C:1")], "B": [], "C": []}[sab]
    xref = {"A": "", "B": "c:1", "C": "umls:c77"}[sab]
    schema = "id string, name string, description string, sab string, source_version string, source string, srl int, ttyl array<string>"
    return lambda: (
        spark.createDataFrame([(*e, i) for i, e in enumerate(edges)], "subject string, predicate string, object string, ord bigint"),
        tables.list_columns(spark.createDataFrame([(f"{sab}:1", f"node {sab}", "", "", xref, 0)], "node_id string, node_label string, node_definition string, node_synonyms string, node_dbxrefs string, ord bigint")),
        spark.createDataFrame([(f"{sab}:{sab}", sab, "", sab, "1", "", None, ["PT"])], schema),
    )


def test_bucketed_tables_are_not_shuffled(spark, tmp_path, small):
    """Only rows of the new source move; the graph's side of every join is read as it lies."""
    stored = known.store_known(small.graph, str(tmp_path / "known"))
    new = spark.createDataFrame([(f"N:{i}", f"n {i}", i) for i in range(50)], "node_id string, node_label string, ord bigint")
    new = new.withColumn("node_synonyms", F.array(F.lit("")))
    listed = new.select("node_id", F.col("node_id").alias("cui"), F.lit(1).alias("pos"))
    xrefs = new.select("node_id", F.lit(0).alias("xref_ord"), F.col("node_label").alias("xref"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frames = {
            "codes": [resolve.transitive_concepts(xrefs, stored.codes), resolve.existing_concepts(new, stored.codes, stored.concepts)],
            "concepts": [ingest.new_concepts(new, listed, stored.concepts, "N")], "terms": [ingest.new_terms(new, stored.terms)],
        }
        for table, own in frames.items():
            for frame in own:
                lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
                scans = [i for i, line in enumerate(lines) if "FileScan" in line and f"known_{table}" in line]
                assert scans
                for at in scans:
                    # walk up from the scan to the join that takes it
                    depth, above = _depth(lines[at]), []
                    for line in reversed(lines[:at]):
                        if _depth(line) < depth:
                            depth = _depth(line)
                            above.append(line)
                            if "Join" in line:
                                break
                    assert "Join" in above[-1] and not any("Exchange" in line for line in above), above
                    assert "Bucketed: true" in lines[at]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _depth(line):
    return len(line) - len(line.lstrip(" :+-*"))


def test_a_bucketed_context_is_the_same(spark, tmp_path):
    sources = [(sab, _moving_source(spark, sab)) for sab in "AB"]
    plain = ingest.build_context(spark, tables.empty_graph(spark), sources, str(tmp_path / "plain"))
    kept = ingest.build_context(spark, tables.empty_graph(spark), sources, str(tmp_path / "kept"), bucketed=True)
    for name, table in plain.tables().items():
        columns = [c for c in table.columns if c != "props"]
        rows = lambda frame, own=columns: sorted(map(str, frame.select(*own).collect()))
        assert rows(table) == rows(getattr(kept, name)), name
    stored = known.load_known(spark, str(tmp_path / "kept/known"))
    assert {r.id for r in stored.terms.collect()} == {r.id for r in kept.terms.collect()}
    with pytest.raises(ValueError, match="one|not with"):
        ingest.build_context(spark, tables.empty_graph(spark), sources, str(tmp_path / "no"), bucketed=True, move_concepts=True)


def test_definitions_are_appended_once(spark, tmp_path):
    found = sheets.definition_rows(spark.createDataFrame([(1, "text"), (2, ""), (1, "text")], "uid bigint, summary string"))
    path = str(tmp_path / "defs")
    sheets.append_table(sheets.new_definitions(found, spark.createDataFrame([], "atui string")), path)
    assert sheets.new_definitions(found, spark.read.parquet(path)).count() == 0
    assert found.first().code == "ENTREZ:1"


def test_sample(spark, small):
    cut = tables.sample_graph(small.graph, max_nodes=4, max_rels=3)
    assert sum(getattr(cut, n).count() for n in tables.NODE_KINDS.values()) == 4
    assert cut.rels.count() + cut.coderels.count() == 3
    assert tables.sample_graph(small.graph).concepts.count() == small.graph.concepts.count()
