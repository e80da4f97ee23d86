import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vocabweave.llm import resampling
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def runs(text, longest):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, least=20, share=(10, 100), seed=2024):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    s = Counter(bucket(run) for _, text in docs for run in runs(text, longest)[1])
    t = Counter(bucket(run) for text in target for run in runs(text, longest)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for i, text in docs:
        words, features = runs(text, longest)
        weight = sum(gain[bucket(run)] for run in features)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[: len(able) * share[0] // share[1]], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def texts(spark, table):
    return [r.text for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select("text").collect()]


def test_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op13_importance_resampling"](spark, FOLDER)) == brute(docs, texts(spark, "benchmark"))


ODD = [
    (1, None), (2, ""), (3, " .,!"), (4, "Äpfel ÄPFEL 12a_b " * 9), (5, "the cat sat " * 20), (5, "the cat sat " * 20), (None, "the dog " * 30), (None, "a cat " * 30),
    ((1 << 62) + 1, "日本 the مرحبا\x00cat\x7fK " * 9), (7, "x" * 5000), (8, "cat " * 30_000), (9, "one two three"), (10, "the cat\n\n\tsat " * 20),
]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 70_000, "least": 1, "share": (1, 2), "seed": 7}])
def test_odd_texts(spark, documents, options):
    target = ["the cat", None, "", "the cat sat on THE mat"]
    wanted = spark.createDataFrame([(1, t, "x") for t in target], "item_id bigint, text string, score string")
    assert rows(resampling.resample(documents(ODD), wanted, **options)) == brute(ODD, target, **options)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert rows(resampling.resample(documents([]), none)) == []
    assert rows(resampling.resample(documents(ODD), none, share=(1, 1))) == brute(ODD, [], share=(1, 1))


def test_equal_rows_get_ranks_of_their_own(spark, documents):
    many = [(3, "word " * 25)] * 500 + [(i, f"word{i} " * 25) for i in range(100)]
    found = resampling.resample(documents(many), spark.createDataFrame([("word",)], "text string"), share=(1, 1))
    assert sorted(r.rank for r in found.where(F.col("rank").isNotNull()).collect()) == list(range(1, 601))
    assert rows(found) == brute(many, ["word"], share=(1, 1))
