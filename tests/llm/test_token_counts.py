import pytest
from tokenizers import Tokenizer

from vocabweave.llm import token_counts
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(token_counts.VOCABULARY)


def brute(doc_id, text):
    n = len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
    return doc_id, len((text or "").encode()), n, n > 1024


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_documents_against_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op12_token_counts"](spark, FOLDER)) == sorted((brute(*r) for r in docs), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, " \n\t  a"), (5, "it's  we'll 12 000 x"), (6, "日本語 text العربية 😀😀"), (6, "日本語 text العربية 😀😀"),
    (None, "a<|endoftext|>b <|endoftext|>  <|endoftext|>"), ((1 << 62) + 1, "big id"), (7, "x" * 5000), (8, "\x00\x01\x1c\x85''s'S<|endoftext|"),
    (9, "word " * 30_000), (10, " " * 3000 + "end" + "\n \t" * 700), (11, "<|endoftext|>"), (12, "aᲉb Ɤ \U000323b0\U000323b0 1\U000323b0"),
]


def test_odd_texts(documents):
    assert rows(token_counts.count(documents(ODD))) == sorted((brute(*r) for r in ODD), key=str)
    assert rows(token_counts.count(documents(ODD), limit=2)) == sorted(((*brute(*r)[:3], brute(*r)[2] > 2) for r in ODD), key=str)


def test_empty_table(documents):
    assert rows(token_counts.count(documents([]))) == []


def test_stretches_and_a_full_table_change_nothing(monkeypatch):
    proof = token_counts.prove()
    whole = token_counts.Counter(proof)
    expected = [whole.of_text(text or "") for _, text in ODD]
    assert expected == [brute(*r)[2] for r in ODD]
    monkeypatch.setattr(token_counts, "STRETCH", 3)
    monkeypatch.setattr(token_counts, "KNOWN", 2)
    assert [token_counts.Counter(proof).of_text(text or "") for _, text in ODD] == expected
    assert all("".join(token_counts.stretches(text or "")) == (text or "") for _, text in ODD)


def test_proven_strings_are_one_token_and_others_are_not():
    proof = token_counts.prove()
    words = [w for w, _ in sorted(LIBRARY.get_vocab().items())[::17]]
    back = {c: b for b, c in enumerate(token_counts.byte_letters())}
    for word in words:
        if word in proof.special:
            continue
        try:
            text = bytes(back[c] for c in word).decode()
        except UnicodeDecodeError:
            continue
        assert (text in proof.whole) == (len(LIBRARY.model.tokenize(word)) == 1)


def test_every_character_is_split_as_the_library_does():
    own = token_counts.splitter()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 61 == 0 or 0xA640 < c < 0xAC00)]
    for at in range(0, len(points), 2000):
        text = "\n".join(f"a{c}1{c}.{c} {c}{c}x" for c in map(chr, points[at : at + 2000]))
        assert own.words(text) == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.prove(token_counts.VOCABULARY.replace("byte_bpe_50k", "word_bpe_49k"))
