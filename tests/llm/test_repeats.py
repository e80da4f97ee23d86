import hashlib

import numpy as np
import pytest

from vocabweave.llm import repeats, suffixes
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    first, out = {}, []
    texts = [(i if i is not None else 1 << 62, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            first[w] = min(first.get(w, (i, k)), (i, k))
    for (i, b), (own, _) in zip(texts, rows, strict=True):
        gone = np.zeros(len(b) + 1, np.int8)
        for k in range(len(b) - 99):
            if first[b[k : k + 100]] != (i, k):
                gone[k : k + 100] = 1
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((own, len(b), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(docs)
    assert rows(QUERIES["op10_repeated_passages"](spark, FOLDER)) == expected
    assert sum(r[2] > 0 for r in expected) > 5


def passages():
    made = np.random.default_rng(3)
    some = lambda n, k=26: bytes(made.integers(97, 97 + k, n).astype(np.uint8)).decode()
    shared = [some(int(n)) for n in made.integers(90, 400, 12)]
    texts = ["".join(some(int(made.integers(0, 80))) + shared[i][int(made.integers(0, 30)) :] for i in made.integers(0, 12, int(made.integers(1, 5)))) for _ in range(60)]
    texts += ["a" * 350, "ab" * 200, "a" * 120 + some(50) + "a" * 130, some(99), shared[0][:100], "é" * 120, "xé" * 90, some(3000, 2)]
    ids = made.permutation(len(texts) * 3)[: len(texts)].tolist()
    return [*zip(ids, texts, strict=True), (None, shared[1] + "!"), (None, shared[1] + "?"), (5000, None), (5001, ""), (ids[0], texts[0]), (ids[1], "z" + texts[1]), (ids[2], texts[2][1:])]


@pytest.mark.parametrize("sizes", [
    repeats.SIZES, repeats.Sizes(500, 1 << 23, 500, 300, 1), repeats.Sizes(3000, 150, 500, 1, 3), repeats.Sizes(3000, 1 << 23, 200, 1 << 17, 50),
])
def test_shared_passages(spark, documents, sizes):
    made = passages()
    assert rows(repeats.digest(documents(made).repartition(4), sizes=sizes)) == brute(made)


def test_equal_blocks_of_one_task(documents):
    text = passages()[0][1] + "z" * 150
    made = [(1, text), (1, text), (2, text), (None, None), (None, None), (1, text), (2, text)]
    found = rows(repeats.digest(documents(made).coalesce(1), sizes=repeats.Sizes(block_bytes=1)))
    assert len(found) == len(made) and found == brute(made)


def test_texts_keep_their_columns(documents):
    line = "the same long line of text, word after word, that comes again and again in very many texts of this small table; yes. "
    made = [(1, line * 2, "en"), (2, "x" + line, "de"), (3, None, "fr"), (4, "short", None)]
    found = {r.doc_id: r for r in repeats.without_repeats(documents(made)).collect()}
    assert [(found[i].text, found[i].lang, found[i].n) for i in (1, 2, 3, 4)] == [(line, "en", 7), ("x", "de", 7), (None, "fr", 7), ("short", None, 7)]
    assert repeats.without_repeats(documents([])).count() == 0


def test_equal_windows_by_hand():
    made = np.random.default_rng(2)
    strings = [bytes(made.integers(97, 99, int(made.integers(1, 30))).astype(np.uint8)) for _ in range(60)] + [b"abcab", b"abcab"]
    shift = np.array([int(made.integers(0, len(s))) for s in strings[:-2]] + [1, 1])
    data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    found = {}
    for string, offset, group in zip(*suffixes.equal_windows(data, np.cumsum(sizes) - sizes, sizes, shift, 4), strict=True):
        found.setdefault(group, set()).add((int(string), int(offset)))
    expected = {}
    for i, s in enumerate(strings):
        for k in range(len(s) - 3):
            expected.setdefault((k - shift[i], s[k : k + 4]), set()).add((i, k))
    assert sorted(map(sorted, found.values())) == sorted(sorted(e) for e in expected.values() if len(e) > 1)


def test_texts_are_spread_over_the_parts(spark):
    """Whatever row of a block comes first, its texts go where the block's digest says."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sizes = repeats.Sizes(block_bytes=1 << 15)
    dealt = documents.mapInArrow(repeats._dealer(33, "doc_id", "text", sizes), repeats.PACKED)
    met = dealt.groupBy("part").applyInArrow(repeats._meeter(2000), repeats.PACKED)
    opened = met.groupBy("block").applyInArrow(repeats._opener(33, "doc_id", "text", repeats._digests("doc_id")), repeats.PACKED)
    homes = [r.part for r in opened.where("kind = 'done'").select("part").collect()]
    assert len(homes) > 40 and max(map(homes.count, set(homes))) < len(homes) / 4
