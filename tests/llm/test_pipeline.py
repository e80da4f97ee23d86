"""The stages against brute force on what each one is given, and the whole run."""


import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_bpe import brute as encode
from test_decontamination import brute as find_passages
from test_jaccard import brute as find_groups
from vocabweave.llm import toxicity
from vocabweave.llm.queries import toxicity_model

FOLDER = "/root/testdata/sf0.001"


def table(df):
    return sorted(map(tuple, df.collect()), key=str)


def uncut(rows):
    """Texts without the bytes of 100-byte strings that start earlier."""
    first = {}
    for r in rows:
        b = (r.text or "").encode()
        for k in range(len(b) - 99):
            first[b[k : k + 100]] = min(first.get(b[k : k + 100], (r.doc_id, k)), (r.doc_id, k))
    for r in rows:
        b, gone = (r.text or "").encode(), set()
        for k in range(len(b) - 99):
            if first[b[k : k + 100]] != (r.doc_id, k):
                gone |= set(range(k, k + 100))
        yield r, bytes(x for i, x in enumerate(b) if i not in gone).decode(errors="ignore")


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity_model(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        docs = spark.createDataFrame(given, docs.schema)
        result = stage(spark, docs, FOLDER)
        found = table(result)
        if name == "toxicity":
            expected = [r for r in given if model.score(r.text) < toxicity.THRESHOLD]
        elif name == "near_duplicates":
            expected = [r for r, (_, n, c) in zip(sorted(given, key=lambda r: str(r.doc_id)), sorted(find_groups([(r.doc_id, r.text) for r in given]), key=lambda x: str(x[0])), strict=True) if c == r.doc_id]
            assert len(expected) < len(given)
        elif name == "repeated_passages":
            expected = [(r.doc_id, text, r.lang, r.source, len(text)) for r, text in uncut(given)]
        elif name == "decontamination":
            bad = {r[0] for r in find_passages([(r.doc_id, r.text) for r in given], items) if r[5]}
            expected = [r for r in given if r.doc_id not in bad]
            assert bad
        else:
            expected = [encode(r.doc_id, r.text) for r in given]
        assert found == sorted(map(tuple, expected), key=str), name
        if name != "encoding":
            assert result.columns == docs.columns
            docs = result


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_one_row_of_each_group(spark, documents, few):
    from vocabweave.llm import jaccard

    made = [(3, "a b c"), (1, "a b c"), (1, "a b c"), (None, "a b c"), (4, "A  B C"), (5, ""), (5, ""), (6, None), (None, "only"), (1, "else"), (7, "else")]
    found = table(jaccard.one_of_each(documents(made), few=few).select("doc_id", "text"))
    assert found == sorted([(1, "a b c"), (5, ""), (5, ""), (6, None), (None, "only"), (1, "else")], key=str)


def test_odd_tables(spark, documents):
    empty = documents([]).drop("n", "score", "key")
    few = documents([(None, None, None), (1, "", "en"), (2, "x" * 300, None)]).drop("n", "score", "key")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0, name
        assert stage(spark, few, FOLDER).count() == 3, name


def test_columns_of_any_name(spark, documents):
    """Names that stages use inside are kept with what they hold; ``n_chars`` need not be there."""
    names = ["set_of_shingles", "_set_of_shingles", "_id", "_node", "id_of_set", "Node_of_id", "toxicity", "_toxicity", "carried", "contaminated", "node", "root", "block", "part", "payload", "n_words", "shingle", "value"]
    made = [(1, "one two three four five six"), (2, "one two three four five six"), (None, None), (4, ""), (5, "y" * 200_000), (5, "else"), (5, "else")]
    docs = documents(made).drop("n_chars", "lang", "source").withColumns({c: F.lit(c) for c in names})
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        ids = sorted(r.doc_id or 0 for r in found.collect())
        assert ids == ([0, 1, 4, 5, 5] if name == "near_duplicates" else [0, 1, 2, 4, 5, 5, 5]), name
        if name != "encoding":
            assert found.columns == docs.columns
            assert all(r[c] == c for r in found.collect() for c in names) and {(r.n, r.score, r.key) for r in found.collect()} == {(7, 0.5, "x")}, name
