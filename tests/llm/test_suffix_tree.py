import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vocabweave.llm import suffix_tree
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def symbols(text):
    return [*WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())), None]


def taught(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


def base(rows):
    counts = Counter(s for i, t in rows if taught(i) for s in symbols(t))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        own = symbols(t)
        out[i] = len(own), sum(counts[s] > 0 for s in own), n, sum(math.log10((counts[s] + 0.5) / (n + 0.5 * (v + 1))) for s in own)
    return out, counts


def tree(rows, counts):
    """Scores by the definition: tested contexts of one and two words, Witten-Bell smoothing."""
    n, v = sum(counts.values()), len(counts)
    after = [defaultdict(Counter), defaultdict(Counter)]
    for i, t in rows:
        own = symbols(t)
        for k in range(1, len(own)) if taught(i) else ():
            after[0][own[k - 1]][own[k]] += 1
            if k > 1:
                after[1][tuple(own[k - 2 : k])][own[k]] += 1
    root = lambda s: (counts[s] + 0.5) / (n + 0.5 * (v + 1))

    def kept(nexts, parent):
        total, kinds = sum(nexts.values()), len(nexts)
        won = sum(c * math.log((c - 1 + kinds * parent(s)) / (total - 1 + kinds) / parent(s)) for s, c in nexts.items()) if total > 1 else 0
        return total >= 2 and won >= suffix_tree.GAIN

    states = {c: x for c, x in after[0].items() if kept(x, root)}

    def one(c, s):
        x = states.get(c)
        return (x[s] + len(x) * root(s)) / (sum(x.values()) + len(x)) if x else root(s)

    longer = {c: x for c, x in after[1].items() if after[0][c[0]][c[1]] >= 2 and kept(x, lambda s, c=c: one(c[1], s))}

    def two(a, c, s):
        x = longer.get((a, c))
        return (x[s] + len(x) * one(c, s)) / (sum(x.values()) + len(x)) if x else one(c, s)

    for i, t in rows:
        own = symbols(t)
        yield i, sum(math.log10(root(s) if k == 0 else one(own[0], s) if k == 1 else two(own[k - 2], own[k - 1], s)) for k, s in enumerate(own))


def test_scores_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in QUERIES["op5_suffix_tree"](spark, FOLDER).collect()}
    expected, counts = base(rows)
    assert found.keys() == expected.keys()
    for i, (n, known, total, value) in expected.items():
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, not taught(i))
        assert math.isclose(r.base_score, value, rel_tol=1e-9)
    # pairs meet their parent's probability in steps, so a few states may differ
    whole = dict(tree(rows, counts))
    off = [abs(found[i].score - s) / found[i].n_tokens for i, s in whole.items()]
    assert sorted(off)[int(0.9 * len(off))] < 0.01 and sum(off) / len(off) < 0.01
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


ODD = [
    (1, None), (2, ""), (3, "a b c a b c a b c"), (3, "a b c a b c a b c"), (4, "A B\nC a b"), (None, "c a b"), (5, "z"), (6, "a b " * 20_000), (7, "new words here"),
    (11, "x y z x y z x y z x y q"), (12, "x y z"),
]


@pytest.mark.parametrize("part_keys", [1_500_000, 3000])
def test_odd_texts(spark, documents, part_keys):
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    found = suffix_tree.score(documents(ODD).repartition(2), fold != 1, part_keys=part_keys).collect()
    assert len(found) == len(ODD)
    expected, _ = base(ODD)
    for r in found:
        n, known, total, value = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, value, rel_tol=1e-9) and -1e6 < r.score <= 0


def test_no_rows_or_no_training(spark, documents):
    assert suffix_tree.score(documents([]), F.lit(True)).count() == 0
    r = suffix_tree.score(documents([(1, "a b")]), F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.score == r.base_score == 0.0


def test_equal_blocks_of_one_task(documents, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 1)
    made = [(1, "a b a b")] * 3 + [(2, "a b")] * 2 + [(1, "a b a b")]
    found = suffix_tree.score(documents(made).coalesce(1), F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in found) == [(1, 5)] * 4 + [(2, 3)] * 2
    assert len({(r.doc_id, r.score) for r in found}) == 2


def close(found, rows):
    counts = base(rows)[1]
    whole = dict(tree(rows, counts))
    off = [abs(r.score - whole[r.doc_id]) / r.n_tokens for r in found]
    assert len(off) == len(rows) and max(off) < 1e-3


def test_all_contexts_with_exact_parents(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 1 << 16)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    close(suffix_tree.score(documents, fold != 1, part_keys=100_000).collect(), [tuple(r) for r in documents.collect()])


@pytest.mark.parametrize("part_keys", [1_500_000, 3000])
def test_hot_contexts(documents, monkeypatch, part_keys):
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 1 << 12)
    made = [(i, "the cat sat on the mat and the cat ran " * 20 + f"the cat w{i % 7} v{i % 3} the cat") for i in range(300)] + [(900, "the cat the cat x")]
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    close(suffix_tree.score(documents(made).repartition(2), fold != 1, part_keys=part_keys).collect(), made)
