import zlib

import pytest
from pyspark.sql import functions as F

from vocabweave.llm import toxicity
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = QUERIES["op2_toxicity"](spark, FOLDER).collect()
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    bad = [h for h in held if h[2]]
    fine = [h for h in held if not h[2]]
    above = sum(b[0] > f[0] for b in bad for f in fine) / len(bad) / len(fine)
    assert above > 0.94
    assert sum(b[1] for b in bad) >= 0.75 * len(bad)
    assert sum(f[1] for f in fine) <= 0.01 * len(fine)


def fitted(spark, texts):
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id bigint, text string, toxic int")
    return toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic", F.lit("x").alias("text")))


@pytest.fixture(scope="module")
def model(spark):
    texts = [("good morning to all of you " + "plain " * (i % 7), 0) for i in range(60)] + [("you rotten skunk and " + "plain " * (i % 5), 1) for i in range(20)]
    return fitted(spark, [*texts, (None, 0), ("no label", None)])


def test_odd_texts(documents, model):
    odd = [(1, None), (2, ""), (3, "rotten skunk " * 3), (3, "rotten skunk " * 3), (None, "good morning"), (4, "all " * 200_000), (5, "$$$ ***")]
    # the column "score" of the table stays as it is
    found = toxicity.score(documents(odd), model, to="toxicity").collect()
    scores = [r.toxicity for r in found]
    assert len(found) == 7 and {r.score for r in found} == {0.5}
    assert all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] == scores[6]
    assert scores[2] == scores[3] > 0.7 > max(scores[4:6])


def test_one_class_or_none(spark, documents):
    for texts, expected in (([], 0.0), ([("a", 1)], 1.0)):
        assert toxicity.score(documents([(1, "a")]), fitted(spark, texts), to="toxicity").first().toxicity == expected
    assert toxicity.score(documents([]), fitted(spark, []), to="toxicity").count() == 0


def test_few_examples(spark, documents):
    model = fitted(spark, [("a b c", 0), ("d e f", 1), ("g", 0)])
    assert toxicity.score(documents([(1, "d e f")]), model, to="toxicity").count() == 1
