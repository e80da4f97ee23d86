import hashlib

import numpy as np
import pytest
import tiktoken

from vocabweave.llm import bpe
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WHOLE = tiktoken.Encoding("whole", pat_str=bpe.PATTERN, mergeable_ranks=bpe.ranks(bpe.VOCABULARY), special_tokens={})


def brute(doc_id, text):
    ids = WHOLE.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_documents_against_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op7_byte_bpe"](spark, FOLDER)) == sorted((brute(*r) for r in docs), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, " \n\t  a"), (5, "it's  we'll 12 000 x"), (6, "日本語 text العربية 😀😀"), (6, "日本語 text العربية 😀😀"),
    (None, "a<|endoftext|>b"), ((1 << 62) + 1, "big id"), (7, "x" * 5000), (8, "\x00\x01''s'S"), (9, "word " * 30_000), (10, " " * 3000 + "end"),
]


@pytest.mark.parametrize("block_chars, part_bytes", [(1 << 20, 1 << 20), (50, 500)])
def test_odd_texts(spark, documents, block_chars, part_bytes):
    sizes = {"block_chars": block_chars, "part_bytes": part_bytes}
    expected = sorted((brute(*r) for r in ODD), key=str)
    assert rows(bpe.digest(documents(ODD).coalesce(1), **sizes)) == expected  # all in one block
    assert rows(bpe.digest(documents(ODD), **sizes)) == expected
    decoded = bpe.decode(bpe.encode(documents(ODD), **sizes)).collect()
    found = [(r.doc_id, len(r.ids) // 4, *(hashlib.sha256(x).hexdigest() for x in (r.ids, r.decoded))) for r in decoded]
    assert sorted(found, key=str) == expected


def test_empty_table(spark, documents):
    assert rows(bpe.digest(documents([]))) == []
