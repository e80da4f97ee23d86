"""Small worked examples of scalar functions, relations and jobs."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vocabweave.functions import codes, text
from vocabweave.operators import affixes, graph_queries, relations
from vocabweave.functions import fixed_values as fixed
from vocabweave.sources import crosswalk, field_vocabulary, oneshot, pathways, proteins, sheets, triples


def value(spark, text_value, expression):
    return spark.createDataFrame([(text_value,)], "x string").select(expression(F.col("x")).alias("v")).first().v


@pytest.mark.parametrize("raw, code", [
    ("umls:c0927176", "UMLS:c0927176"),
    ("umls_cui:x", "UMLS:cui x"),
    ("fma:59772", "FMA:59772"),
    ("fma59772", "FMA:59772"),
    ("http://ncicb.nci.nih.gov/xml/owl/EVS/Thesaurus.owl#C123", "NCI:C123"),
    ("http://edamontology.org/format_3750", "EDAM:format_3750"),
    ("EDAM:format_3750", "EDAM:format_3750"),
    ("http://purl.obolibrary.org/obo/UBERON_0008789", "UBERON:0008789"),
    ("REACTOME_VS:C0006", "REACTOME_VS:C0006"),
    ("HGNC HGNC:5", "HGNC:5"),
    ("C0001", "UMLS:C0001"),
    ("CURATED", "CURATED"),
    ("C", "C"),
    (None, None),
])
def test_code(spark, raw, code):
    assert value(spark, raw, codes.standardize_code) == code


def test_code_as_coded(spark):
    as_coded = lambda x: codes.standardize_code(x, as_coded=True)
    assert value(spark, "EDAM:format_3750", as_coded) == "format_3750"
    assert value(spark, "CURATED", as_coded) == "UMLS:CURATED"


def test_prefix_maps_only_for_their_sources(spark):
    iri = "http://uri.neuinfo.org/nif/nifstd/nlx_cell_12"
    assert value(spark, iri, lambda x: codes.standardize_code(x, "NPO")) == "NIFSDT.NLX.CELL:12"
    assert value(spark, iri, lambda x: codes.standardize_code(x, "CL")) == "NLX:cell 12"
    iri = "http://www.mmrrc.org/catalog/getSDS.jsp?mmrrc_id=7"
    assert value(spark, iri, lambda x: codes.standardize_code(x, "NPO")) == "MMRRC:7"


def test_clean_concept_id(spark):
    assert value(spark, "UMLS:CUI C1", codes.clean_concept_id) == "UMLS:C1"


def test_version(spark):
    assert value(spark, "ENSG00000227232.5", codes.strip_version) == "ENSG00000227232"
    assert value(spark, "ENSG00000227232.5", codes.version_of) == "5"


def test_parentheses(spark):
    groups = value(spark, "(a(b(c)(d)e)(f)g)", text.parenthesis_groups)
    assert [tuple(g) for g in groups] == [(2, "c"), (2, "d"), (1, "b(c)(d)e"), (1, "f"), (0, "a(b(c)(d)e)(f)g")]
    names = "Plasminogen receptor (KT) (Plg-R(KT))"
    assert value(spark, names, text.recommended_name) == "Plasminogen receptor"
    assert value(spark, names, text.outer_groups) == ["KT", "Plg-R(KT)"]
    assert value(spark, ") a ( b", text.parenthesis_groups) == []


def test_bracket_ids(spark):
    cell = "amyloid-beta metabolic process [GO:0050435]; apoptotic process [GO:0006915]"
    assert value(spark, cell, text.bracket_ids) == ["GO:0050435", "GO:0006915"]


def test_pipe_list(spark):
    assert len(value(spark, "emapa:35663|fma:55566|umls:c0927176|ma:0002676|ncit:c33265", text.pipe_split)) == 5
    assert value(spark, None, text.pipe_split) == [""]


@pytest.mark.parametrize("key, expected", [
    ("gene_id", "ENSG00000223972.5"), ("tag", "basic,Ensembl_canonical"), ("level", "2"), ("gene", ""), ("note", "two words"),
])
def test_key_values(spark, key, expected):
    cell = 'gene_id "ENSG00000223972.5";  transcript_id "ENST1.2"; tag "basic"; level 2;tag "Ensembl_canonical"; note "two words";'
    assert value(spark, cell, lambda x: text.values_of_key(text.tidy_key_values(x), key)) == expected


@pytest.mark.parametrize("label, expected", [("part-of (x).y", "part_of__x__y"), ("2d_part", "rel_2d_part")])
def test_relation_format(spark, label, expected):
    assert value(spark, label, relations.format_relation) == expected


def reference(spark):
    nodes = spark.createDataFrame(
        [("http://purl.obolibrary.org/obo/RO_1", "has part", 0), ("http://purl.obolibrary.org/obo/RO_2", "part of", 1), ("http://purl.obolibrary.org/obo/RO_3", "eats", 2)],
        "id string, lbl string, ord bigint",
    )
    edges = spark.createDataFrame([("http://purl.obolibrary.org/obo/RO_1", "inverseOf", "http://purl.obolibrary.org/obo/RO_2", 0)], "sub string, pred string, obj string, ord bigint")
    return relations.relation_inverses(nodes, edges)


def test_one_sided_inverse_is_completed(spark):
    rows = {r.label: r.inverse_label for r in reference(spark).collect()}
    assert rows == {"has_part": "part_of", "part_of": "has_part", "eats": None}


@pytest.mark.parametrize("predicate, label, inverse", [
    ("http://purl.obolibrary.org/obo/RO_1", "has_part", "part_of"),
    ("RO:2", "part_of", "has_part"),
    ("part of", "part_of", "has_part"),
    ("RO:3", "eats", "inverse_eats"),
    ("http://purl.obolibrary.org/obo/uberon/core#proximally_connected_to", "proximally_connected_to", "inverse_proximally_connected_to"),
    ("http://www.w3.org/2000/01/rdf-schema#subClassOf", "isa", "inverse_isa"),
    ("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "isa", "inverse_isa"),
    ("http://www.ebi.ac.uk/efo/EFO_0000784", "has_disease_location", "inverse_has_disease_location"),
    ("http://purl.obolibrary.org/obo/OBIB_0000734", "is_contact_information_for", "inverse_is_contact_information_for"),
])
def test_relation_precedence(spark, predicate, label, inverse):
    predicates = spark.createDataFrame([(predicate,)], "predicate string")
    row = relations.relation_names(predicates, reference(spark)).first()
    assert (row.relation_label, row.inverse_label) == (label, inverse)


def test_crosswalk_row(spark):
    rows = spark.createDataFrame(
        [("Heart_L2", "UBERON:000094", "Adipocyte", "AZ:0000001", "CL:0000136", 0)],
        "Organ_Level string, Organ_ID string, Annotation_Label string, Annotation_Label_ID string, CL_ID string, ord bigint",
    )
    nodes = {r.node_id: (r.node_label, r.node_dbxrefs) for r in crosswalk.crosswalk_nodes(rows, "AZ").collect()}
    assert nodes["AZ:0000001"] == ("AZ_Heart_L2_Adipocyte", "CL:0000136")
    assert nodes["AZ:1000001"] == ("AZ_Heart_L2", "")
    edges = {tuple(r) for r in crosswalk.crosswalk_edges(rows, "AZ").collect()}
    assert ("AZ:0000001", "located_in", "AZ:1000001") in edges and ("AZ:1000001", "part_of", "UBERON:000094") in edges


def test_template_entities(spark):
    edges = spark.createDataFrame([(f"https://x/templates/{t}", "https://schema.metadatacenter.org/core/Template") for t in "abc"], "subject string, object string")
    entities = spark.createDataFrame([("CEDAR:a", "A:1", "B:1", 0), ("CEDAR:b", "A:2", "", 1)], "id string, first string, second string, ord bigint")
    rows = sorted((r.subject, r.object) for r in sheets.template_entity_map(edges, entities, ["first", "second"]).collect())
    assert rows == [("CEDAR:a", "A:1"), ("CEDAR:a", "B:1"), ("CEDAR:b", "A:2"), ("CEDAR:c", "HUBMAP:C040001"), ("CEDAR:c", "SENNET:C050002")]


def test_undefined_term_stops_the_job(spark):
    sheet = spark.createDataFrame([("a", "S:1", "", "", "", "b,nowhere", 0), ("b", "S:2", "", "", "", "", 1)],
                                  "term string, code string, definition string, synonyms string, dbxrefs string, parents string, ord bigint")
    with pytest.raises(PySparkException, match="nowhere"):
        sheets.term_codes(sheets.unpivot_relations(sheet), sheet).collect()


def test_alternative_columns(spark):
    table = spark.createDataFrame([("x", "nan", None)], "id string, Synonyms string, Definitions string")
    row = table.select(
        text.first_column(table, ["has_exact_synonym", "Synonyms"]).alias("s"),
        text.first_column(table, ["definition", "Definitions"]).alias("d"),
        text.first_column(table, ["database_cross_reference"]).alias("x"),
    ).first()
    assert tuple(row) == ("None", "None", "None")


def test_deep_tree(spark):
    body = '{"stId":"n9","type":"t"}'
    for level in range(8, -1, -1):
        body = f'{{"stId":"n{level}","type":"t","children":[{body}]}}'
    rows = pathways.flatten_trees(spark.createDataFrame([(body,)], "body string"), "body").collect()
    assert sorted((r.id, r.parent, r.depth) for r in rows) == [(f"n{i}", f"n{i - 1}" if i else None, i) for i in range(10)]


def test_paths(spark):
    rels = spark.createDataFrame([("r", a, b, "S") for a, b in ("AB", "BC", "AC", "CD", "DE", "XB")], "label string, start_id string, end_id string, sab string")
    start = spark.createDataFrame([("A",)], "cui string")
    reached = {(r.cui, r.depth) for r in graph_queries.path_expand(rels, start, ["r"], "S", 1, 3).collect()}
    assert reached == {("B", 1), ("C", 1), ("D", 2), ("E", 3)}
    longest = graph_queries.longest_paths(rels, start, ["r"], 9).first()
    assert (longest.hops, longest.path) == (4, "A>B>C>D>E")


def test_longest_paths_are_the_smallest_of_their_length(spark):
    """Against walks in plain Python, the smallest per end and length, with many paths of one length, starts without a path and more hops than joins in one plan."""
    edges = {(f"{level:02d}{a}", f"{level + 1:02d}{b}") for level in range(12) for a in "cab" for b in "cab" if (level, a, b) not in {(0, "a", "a"), (3, "c", "a"), (11, "b", "c")}}
    edges |= {("00a", "05c"), ("07b", "12z"), ("S", "00b"), ("S", "00c")}
    rels = spark.createDataFrame([("r", a, b, "S") for a, b in edges], "label string, start_id string, end_id string, sab string")
    starts = ["00a", "03b", "S", "12a", "nowhere"]
    for most in (1, 4, 11, 20):
        best = {}
        for start in starts:
            walks = [(start,)]
            for hops in range(1, most + 1):
                walks = [w + (b,) for w in walks for a, b in edges if a == w[-1]]
                if not walks:
                    break
                walks = [min(w for w in walks if w[-1] == end) for end in {w[-1] for w in walks}]
                best[start] = (min(walks)[-1], hops, ">".join(min(walks)))
        found = graph_queries.longest_paths(rels, spark.createDataFrame([(s,) for s in starts], "cui string"), ["r"], most)
        assert {r.start: (r.cui, r.hops, r.path) for r in found.collect()} == best, most


def test_cycle_is_an_error(spark):
    rels = spark.createDataFrame([("r", "A", "B", "S"), ("r", "B", "A", "S")], "label string, start_id string, end_id string, sab string")
    with pytest.raises(PySparkException, match="cycle"):
        graph_queries.longest_paths(rels, spark.createDataFrame([("A",)], "cui string"), ["r"], 5).collect()


def test_padded_ids(spark):
    ids = spark.createDataFrame([(7,), (12345,)], "n bigint").select(field_vocabulary.padded_id(F.col("n"), "H")).collect()
    assert [r[0] for r in ids] == ["H:0007", "H:12345"]


def test_protein_without_symbol_keeps_its_terms(spark):
    columns = ["Entry", "Entry Name", "Protein names", "Gene Names", "Function [CC]", *[c for c, _ in proteins.ASPECTS]]
    rows = spark.createDataFrame([("P1", "E", "N", "zzz", "", "a [GO:1]", "", "b [x] c [GO:2]")], columns)
    symbols = spark.createDataFrame([("HGNC:1", "abc", 0)], ["HGNC ID", "Approved symbol", "ord"])
    edges = {tuple(r) for r in proteins.protein_edges(rows, symbols).collect()}
    assert edges == {("UNIPROTKB:P1", "involved_in", "GO:1"), ("UNIPROTKB:P1", "enables", "GO:2")}


def test_oneshot_keeps_every_synonym(spark):
    rows = spark.createDataFrame([("http://x/obo/A_1", "a", "None", "b|c|a", None)], "node_id string, node_label string, node_definition string, node_synonyms string, node_dbxrefs string")
    got = sorted((r.kind, r.id) for r in oneshot.oneshot_nodes(rows).collect())
    assert got == [("Concept", "A:1"), ("Term", "a"), ("Term", "b"), ("Term", "c")]


def test_maps_of_any_size(spark):
    keys = spark.range(50_000).select(F.concat(F.lit("_"), F.col("id").cast("string")).alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("ord"))
    keys = keys.unionByName(spark.createDataFrame([("", "none", -1), (None, "none", -2), ("_7", "again", 60_000), ("c_1", "longer", 5)], "key string, value string, ord bigint"))
    texts = spark.createDataFrame([(1, "abc_49999"), (2, "abc_1"), (2, "abc_1"), (3, "7"), (4, None), (5, ""), (6, "x_7"), (7, "_12_3")], "id int, value string")
    found = affixes.affix_join(texts, "value", keys, "hit")
    assert sorted((r.id, r.hit) for r in found.collect()) == [(1, "49999"), (2, "1"), (2, "1"), (3, None), (4, None), (5, None), (6, "7"), (7, "3")]
    assert sorted((r.id, r.hit) for r in affixes.affix_join(texts, "value", keys, "hit", last=True).collect()) == [
        (1, "49999"), (2, "longer"), (2, "longer"), (3, None), (4, None), (5, None), (6, "again"), (7, "3")]
    held = affixes.affix_join(texts, "value", keys, "hit", "inside", last=True)
    assert {r.id: r.hit for r in held.collect()} == {1: "49999", 2: "longer", 3: None, 4: None, 5: None, 6: "again", 7: "12"}
    begun = affixes.affix_join(texts, "value", keys, "hit", "prefix")
    assert {r.id: r.hit for r in begun.collect()} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: None, 7: "1"}
    assert {r.hit for r in affixes.affix_join(texts, "value", keys.limit(0), "hit").collect()} == {None}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_relation_names_by_a_map_table(spark):
    reference = spark.createDataFrame([], "iri string, label string, inverse_label string, ord bigint")
    predicates = spark.createDataFrame([("http://x/a#EFO_12",), ("http://x/part_of",), ("plain",)], "predicate string")
    table = spark.createDataFrame([("efo_12 ", "has part", 1), ("12", "other", 2)], "key string, value string, ord int")
    named = lambda pairs: {r.predicate: r.relation_label for r in relations.relation_names(predicates, reference, pairs=pairs).collect()}
    expected = {"http://x/a#EFO_12": "has_part", "http://x/part_of": "part_of", "plain": "plain"}
    assert named(table) == named([("efo_12 ", "has part"), ("12", "other")]) == expected


def test_axioms_and_long_lists_become_links(spark):
    iri = lambda name: f"http://x.org/{name}"
    rows = [(iri(f"m{i}"), fixed.RDF_TYPE, fixed.OWL_CLASS) for i in range(1000)] + [(iri(c), fixed.RDF_TYPE, fixed.OWL_CLASS) for c in "ABCDEFG"]
    # a class equal to an intersection of 1,000 members, the last of which is an intersection of D and a restriction
    rows += [(iri("A"), fixed.OWL_EQUIVALENT, "_:i"), ("_:i", fixed.OWL_INTERSECTION, "_:c0")]
    rows += [(f"_:c{i}", fixed.RDF_FIRST, iri(f"m{i}")) for i in range(1000)] + [("_:c1000", fixed.RDF_FIRST, "_:j")]
    rows += [(f"_:c{i}", fixed.RDF_REST, f"_:c{i + 1}") for i in range(1000)] + [("_:c1000", fixed.RDF_REST, fixed.RDF_NIL)]
    rows += [("_:j", fixed.OWL_INTERSECTION, "_:d0"), ("_:d0", fixed.RDF_FIRST, iri("D")), ("_:d0", fixed.RDF_REST, "_:d1"), ("_:d1", fixed.RDF_FIRST, "_:r"), ("_:d1", fixed.RDF_REST, fixed.RDF_NIL)]
    # the restriction's filler is an intersection of E and F
    rows += [("_:r", fixed.OWL_ON_PROPERTY, iri("p")), ("_:r", fixed.OWL_FILLERS[0], "_:k"), ("_:k", fixed.OWL_INTERSECTION, "_:e0")]
    rows += [("_:e0", fixed.RDF_FIRST, iri("E")), ("_:e0", fixed.RDF_REST, "_:e1"), ("_:e1", fixed.RDF_FIRST, iri("F")), ("_:e1", fixed.RDF_REST, fixed.RDF_NIL)]
    # G is the union of B and C; B is below a restriction
    rows += [(iri("G"), fixed.OWL_EQUIVALENT, "_:u"), ("_:u", fixed.OWL_UNION, "_:f0"), ("_:f0", fixed.RDF_FIRST, iri("B")), ("_:f0", fixed.RDF_REST, "_:f1")]
    rows += [("_:f1", fixed.RDF_FIRST, iri("C")), ("_:f1", fixed.RDF_REST, fixed.RDF_NIL), (iri("B"), fixed.RDFS_SUBCLASS, "_:s"), ("_:s", fixed.OWL_ON_PROPERTY, iri("q")), ("_:s", fixed.OWL_FILLERS[1], iri("C"))]
    # an axiom on two classes, one on a text, one on something that is no class
    axiom = lambda name, target, kind=iri("says"): [(name, fixed.RDF_TYPE, fixed.OWL_AXIOM), (name, fixed.OWL_SOURCE, iri("B")), (name, fixed.OWL_PROPERTY, kind), (name, fixed.OWL_TARGET, target)]
    rows += axiom("_:x", iri("D")) + axiom("_:y", "a text") + axiom("_:z", iri("thing")) + [(iri("thing"), fixed.RDF_TYPE, iri("Kind"))] + axiom("_:w", iri("open"))
    table = spark.createDataFrame(rows, "s string, p string, o string")
    short = lambda frame: {tuple(v.removeprefix("http://x.org/") for v in r) for r in frame.collect()}
    below = fixed.RDFS_SUBCLASS
    assert short(triples.stated_links(table)) == {("B", "says", "D"), ("B", "says", "open")}
    assert short(triples.decoded_links(table)) == {
        *[("A", below, f"m{i}") for i in range(1000)], ("A", below, "D"), ("A", "p", "E"), ("A", "p", "F"),
        ("B", below, "G"), ("C", below, "G"), ("B", "q", "C")}
    assert short(triples.class_links(table).select("s", "p", "o")) == set()
    assert triples.logical_links(table.limit(0)).count() == 0
