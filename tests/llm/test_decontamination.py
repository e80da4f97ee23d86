import hashlib
import re

import pytest
from pyspark.sql import functions as F

from vocabweave.llm import decontamination
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute(documents, items):
    wanted = {}
    for item, text in items:
        own = split(text)
        for i in range(max(len(own) - 12, 1) if own else 0):
            wanted.setdefault(tuple(own[i : i + 13]), set()).add(str(item))
    sizes = {len(w) for w in wanted}
    for doc_id, text in documents:
        own, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (ids := wanted.get(tuple(own[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc_id, len(own), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(own)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_documents_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    found = rows(QUERIES["op4_decontamination"](spark, FOLDER))
    assert found == sorted(expected, key=str)
    assert any(r[2] for r in found)


LONG = " ".join(f"w{i % 997}" for i in range(60_000))
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Tiny item"), (3, ""), (4, None),
    (5, "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (10, "tiny item"), (None, "lonely words"),
    (11, " ".join(f"w{i}" for i in range(300, 330))),
]
DOCUMENTS = [
    (0, None), (1, ""), (2, "TINY, item!"), (2, "TINY, item!"), (3, "tiny"), (4, "lonely words"), (None, "x tiny item tiny item"),
    (5, "a one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen z"),
    (6, "one two three four five six seven eight nine ten eleven twelve"), (7, "tinyitem"), (8, LONG), (9, "é tiny\x00item ß"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_odd_rows(spark, documents, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("n_hit", F.lit(3))
    found = decontamination.passages(documents(DOCUMENTS), items, block_bytes=block_bytes)
    expected = brute(DOCUMENTS, [i for i in ITEMS if i[0] is not None])
    assert rows(decontamination.digest(found)) == sorted(expected, key=str)


def test_repeated_items_do_not_fill_a_block(spark, documents, monkeypatch):
    taken = []
    begin = decontamination.Windows.__init__
    monkeypatch.setattr(decontamination.Windows, "__init__", lambda self, ids, *rest: (taken.append(len(ids)), begin(self, ids, *rest))[1])
    items = spark.createDataFrame(ITEMS + ITEMS[1:2] * 500, "item_id bigint, text string")
    found = decontamination.passages(documents(DOCUMENTS), items, block_bytes=1000)
    assert rows(decontamination.digest(found)) == sorted(brute(DOCUMENTS, [i for i in ITEMS if i[0] is not None]), key=str)
    assert sum(taken) == 7


def test_spans(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = {r.doc_id: r for r in decontamination.passages(documents(DOCUMENTS), items).collect()}
    assert (found[5].starts, found[5].ends, found[5].items) == ([1], [16], ["1", "5"])
    assert (found[None].starts, found[None].ends) == ([1], [5])


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.passages(documents([]), none).count() == 0
    found = decontamination.digest(decontamination.passages(documents([(1, "a b")]), none)).first()
    assert (found.n_words, found.n_hit, found.n_items, found.contaminated) == (2, 0, 0, False)
