"""Steps that must not shuffle more, or walk in more rounds, than their rows need."""

from pyspark.sql import functions as F

from vocabweave import session
from vocabweave.operators import keyed, resolve
from vocabweave.plans import ingest
from vocabweave.sources import annotations, pathways, tables


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_hot_values_of_a_valueset_are_not_shuffled(spark):
    values = spark.range(1000).select("id", F.when(F.col("id") >= 0, "exon").otherwise("gene").alias("value"))
    valueset = spark.createDataFrame([("exon", "VS:1", 2), ("exon", "VS:0", 1), ("gene", "VS:2", 3)], "node_label string, node_id string, ord long")
    coded = annotations.valueset_codes(values, valueset)
    assert "BroadcastHashJoin" in plan(coded) and "hashpartitioning(value" not in plan(coded)
    assert [tuple(r) for r in coded.groupBy("value", "code").count().collect()] == [("exon", "VS:0", 1000)]


def test_concepts_of_a_node_are_shuffled_once(spark):
    rows = [("n1", 2, 1, "A"), ("n1", 1, 5, "B"), ("n1", 1, 2, "A"), ("n2", 4, 0, "C"), (None, 1, 0, "D"), ("n1", 2, 1, "A")]
    candidates = spark.createDataFrame(rows, "node_id string, rank int, xref_ord long, cui string").select(
        "node_id", "rank", "xref_ord", F.lit(0).alias("step"), F.lit(0).cast("long").alias("ord"), F.lit(0).cast("long").alias("pos"), "cui")
    assigned = spark.createDataFrame([("n1", "N1"), ("n2", "C")], "node_id string, assigned_cui string")
    numbered = resolve.concept_positions(candidates, assigned)
    assert numbered._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") == 1
    assert {tuple(r) for r in numbered.collect()} == {("n1", "A", 1, 1), ("n1", "B", 1, 2), ("n1", "N1", 6, 3), ("n2", "C", 4, 1), (None, "D", 1, 1)}


def test_a_group_of_many_nodes_is_walked_without_rounds(spark, monkeypatch):
    def rounds(offers):
        raise AssertionError("offered in rounds")

    monkeypatch.setattr(resolve, "_offers_round", rounds)
    nodes = spark.range(60_000).select(F.format_string("n%06d", "id").alias("node_id"), F.col("id").alias("ord"))
    lists = nodes.select("node_id", F.explode(F.array(
        F.struct(F.lit(1).alias("pos"), F.lit("shared").alias("cui")), F.struct(F.lit(2).alias("pos"), F.concat(F.lit("c"), (F.col("ord") / 2).cast("long")).alias("cui"))
    )).alias("l")).select("node_id", "l.*")
    choice = nodes.select("node_id", F.lit(1).alias("rank"), F.lit("shared").alias("cui"))
    got = {r.node_id: r.assigned_cui for r in resolve.resolve_shared_greedy(choice, lists, nodes).collect()}
    assert len(got) == 60_000 and got["n000000"] == "shared" and got["n000001"] == "c0"
    assert got["n000002"] == "c1" and got["n000003"] == "n000003"


def test_a_cell_is_cut_once_for_all_keys(spark):
    rows = spark.createDataFrame([('a "1"; b "x;y";a "2"; c z', 1), (None, 2), ("", 3)], "column_9 string, ord long")
    split = annotations.split_key_values(rows, ["a", "b", "c", "d"])
    assert split._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [tuple(r) for r in split.orderBy("ord").collect()] == [(1, "1,2", "x", "z", ""), (2, None, None, None, None), (3, "", "", "", "")]


def test_nodes_of_annotations_read_their_transcripts_once(spark, monkeypatch):
    columns = ["feature_type", "gene_id", "transcript_id", "gene_name", "transcript_name", "hgnc_id", "genomic_start_location", "genomic_end_location"]
    rows = [("gene", "G1.2", "", "g", "", "H:1", "1", "9", 1), ("transcript", "G1.2", "T1.1", "g", "t", "H:1", "2", "8", 2), ("exon", "G1.2", "T1.1", "g", "t", "", "3", "4", 3)]
    parsed = spark.createDataFrame(rows, [*columns, "ord"])
    metadata = {
        name: spark.createDataFrame([("T1.1", *["7"] * len(named), 1)], ["transcript_id", *named, "ord"]) for name, named in annotations.METADATA_COLUMNS.items()
    }
    calls = []
    monkeypatch.setattr(annotations, "cut_lineage", lambda df, **kw: calls.append(df) or session.cut_lineage(df, **kw))
    nodes = annotations.annotation_nodes(parsed, metadata)
    # what is left to do is one choice per gene and one per Entrez gene
    assert len(calls) == 2 and nodes._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number") == 2
    assert sorted(r.node_id for r in nodes.collect()) == ["ENSEMBL:G1", "ENSEMBL:T1", "ENTREZ:7", "REFSEQ:7", "REFSEQ:7"]


def test_pathway_joins_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(keyed, "TASK_ROWS", 10)
    events = spark.range(60).select(F.concat(F.lit("C"), "id").alias("id"), F.lit("9606").alias("taxon"))
    details = events.select("id", F.lit('{"displayName":"x","compartment":[{"accession":"A"}]}').alias("body"))
    edges = pathways.property_edges(events, details)
    assert plan(edges).count("REPARTITION_BY_NUM") >= 2 and ", 13)" in plan(edges)
    assert edges.groupBy("predicate").count().orderBy("predicate").collect() == [("in_taxon", 60), ("part_of", 60)]
    tree = events.select(F.col("id").alias("subject"), F.lit("isa").alias("predicate"), F.lit("REACTOME_VS:C0011").alias("object"))
    tree = tree.union(tree).withColumn("subject", F.concat(F.lit("REACTOME:"), "subject"))
    parts = events.select("id", F.lit('[{"className":"Molecule","databaseName":"chebi","identifier":"1"}]').alias("body"))
    found = pathways.participant_edges(tree, parts)
    assert "REPARTITION_BY_NUM" in plan(found) and found.count() == 60


def test_links_of_a_context_are_worked_out_once(spark, tmp_path, monkeypatch):
    runs = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda text: runs.add(1) or text)
    edges = spark.createDataFrame([("A:1", "in", "B:1", 1), ("A:2", "in", "A:2", 2)], "subject string, predicate string, object string, ord long")
    nodes = spark.createDataFrame([("A:1", "one", "", ["s"], [""], 1)], "node_id string, node_label string, node_definition string, node_synonyms array<string>, node_dbxrefs array<string>, ord long")
    source = spark.createDataFrame([("A:A", "A", "", "A", "1", "", None, ["PT"])], "id string, name string, description string, sab string, source_version string, source string, srl int, ttyl array<string>")
    real = ingest.edges_to_rels
    monkeypatch.setattr(ingest, "edges_to_rels", lambda *given: real(*given).withColumn("label", seen("label")))
    graph = ingest.build_context(spark, tables.empty_graph(spark), [("A", lambda: (edges, nodes, source))], str(tmp_path / "context"))
    assert runs.value == 2 and [tuple(r) for r in graph.rels.select("label", "start_id", "end_id").collect()] == [("in", "A:1", "B:1")]
