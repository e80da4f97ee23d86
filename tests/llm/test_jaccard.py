import re

import numpy as np
import pytest

from vocabweave.llm import jaccard, links
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    own = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))} if own else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    names = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            names[find(k)] = min(i, names.get(find(k), i))
    return sorted([(i, len(s), names.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)], key=str)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_all_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(docs)
    assert rows(QUERIES["op1_ngram_jaccard_join"](spark, FOLDER)) == expected
    assert any(c != i for i, _, c in expected)


def near_copies():
    """Groups of texts of many lengths with changes about the threshold, and common passages."""
    made = np.random.default_rng(5)
    texts = []
    for group in range(12):
        base = [f"w{x}" for x in made.integers(0, 400 if group % 3 else 40, int(made.integers(3, 160)))]
        texts.append(" ".join(base))
        for _ in range(int(made.integers(2, 14))):
            own = list(base)
            for _ in range(int(made.integers(0, max(2, len(own) // 18)))):
                at = int(made.integers(0, len(own)))
                own[at : at + int(made.integers(0, 2))] = [f"x{made.integers(0, 9)}"]
            texts.append(" ".join(own))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"u{k}_{i}" for i in range(int(made.integers(5, 30)))) for k in range(40)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("stars, part_shingles", [(2, 2_000_000), (0, 500), (1, 100)])
def test_near_copies(spark, documents, stars, part_shingles):
    made = near_copies()
    found = jaccard.join(documents(made).repartition(3), stars=stars, part_shingles=part_shingles, heavy_from=6)
    assert rows(found) == brute(made)


def test_odd_texts(spark, documents):
    long = " ".join(f"v{i % 5000}" for i in range(40_000))
    odd = [
        (9, None), (8, ""), (7, " \t\n"), (6, "a b"), (5, "A\nB"), (4, "a b c"), (None, "a b"), (3, long), (2, long + " end"), (2, "a b"), (2, "other"),
        (1, "x y"), (0, "x y"), (12, "é È"), (11, "É È"), (10, "é È"),
    ]
    assert rows(jaccard.join(documents(odd))) == brute(odd)
    assert rows(jaccard.join(documents([]))) == []


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(1, 300)] + [(500 + i, 900) for i in range(20)] + [(7, 7)]
    found = {r.node: r.root for r in links.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {i: 1 for i in range(2, 301)} | {i: 500 for i in [*range(501, 520), 900]}
