import zlib

import numpy as np

from vocabweave.llm import language
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op6_language_id"](spark, FOLDER).collect()
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(found) == len(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.97 * len(held)


def test_odd_texts(spark, documents):
    taught = documents([(i, "the quick brown fox and the lazy dog", "en") for i in range(30)] + [(i, "der schnelle braune fuchs und der faule hund", "de") for i in range(30, 50)] + [(99, "nothing", None), (98, None, "en")])
    model = language.fit(taught)
    assert model.languages == ["en", "de"]
    odd = [(1, None), (2, ""), (3, "12 + 4 !"), (4, "the dog"), (4, "the dog"), (None, "und der hund"), (5, "日本"), (6, "der faule fuchs " * 20_000)]
    found = language.predict(documents(odd), model, to=("guess", "sure")).collect()
    assert [r.guess for r in found] == ["und", "und", "und", "en", "en", "de", "en", "de"]
    assert found[0].sure == 0 and found[7].sure > 0.8 and {r.score for r in found} == {0.5}
    none = language.fit(documents([]))
    assert language.predict(documents([(1, "a")]), none, to=("guess", "sure")).first().guess == "und"
    assert language.predict(documents([]), none, to=("guess", "sure")).count() == 0


def test_more_languages_than_a_mask_holds():
    known = {f"l{i}": np.arange(i * 100, i * 100 + 100).astype(np.uint64) + (np.uint64(3) << np.uint64(24)) for i in range(70)}
    model = language.Filter.of(known)
    assert len(model.tables) == 2 and (model.false_positive < 1e-3).all()


def test_counts_are_those_of_the_sets():
    texts = [b"abc abd", b"", b"x", "straße".encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    for size, (value, bounds) in zip(language.SIZES, language.grams(data, offsets), strict=True):
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            whole = b" " + text + b" "
            expected = [int.from_bytes(bytes([size]) + whole[i : i + size]) for i in range(len(whole) - size + 1)]
            assert value[a:b].tolist() == expected
