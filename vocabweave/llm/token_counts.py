"""Token counts of whole texts under a byte-level BPE vocabulary, without building the ids.

1. Offline, before any text is read, every vocabulary string is put through the merges by itself.
   A string that comes out as one token is proven: BPE sees nothing but the pre-token, so wherever
   that string is a pre-token, it is one token. (A vocabulary string need not be: another merge
   may come first and block it.) The proof goes to the tasks as a broadcast whose size is that of
   the vocabulary, never of the texts.
2. Texts are cut at special tokens, which count as one token each, and then into pre-tokens. A
   proven pre-token counts as one; only the rest is merged, by the library's own model. Counts of
   merged words are kept in a table of at most ``KNOWN`` short words that is emptied when full.

No row meets another, so there is no shuffle and no hot key, and a lost task is only read again.

Null and empty texts have no tokens. Texts of any length are counted whole: long ones are taken in
stretches that end before white space, where every pre-token ends. Repeated rows and repeated or
null ids are kept as they are, an empty table gives no rows, and other columns are ignored whatever
their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import groupby
from typing import NamedTuple

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
KNOWN = 200_000
LONGEST_KNOWN = 64
STRETCH = 1 << 20


class Proof(NamedTuple):
    """A tokenizer file, its special strings and the strings that are one token alone."""

    file: str
    special: tuple[str, ...]
    whole: frozenset[str]


@cache
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = dict.fromkeys(shown) | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] or chr(b) for b in range(256)]


def spelled(text: str) -> str:
    """``text`` in the letters of a byte-level vocabulary."""
    letters = byte_letters()
    return "".join([letters[b] for b in text.encode()])


_LETTER, _DIGIT, _OTHER = r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"


def _pattern(letter: str, digit: str, other: str) -> regex.Pattern:
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{other}+|\s+(?!\S)|\s+")


class Splitter:
    """The byte-level split into pre-tokens, with the letters and digits that the tokenizer library knows.

    The library and the regex module follow different Unicode versions. Characters that Python
    doesn't know yet are tried in both, and texts that hold one they differ on take a pattern of
    their own.
    """

    def __init__(self):
        library, both = pre_tokenizers.ByteLevel(add_prefix_space=False), regex.compile(r"[\p{L}\p{N}]")
        young = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and both.match(c)]
        apart = [c for c in young if all(len(library.pre_tokenize_str(x + c)) == 2 for x in "a1")]
        # runs of code points, each from the first whose difference to its number is new
        runs = [list(run) for _, run in groupby(enumerate(map(ord, apart)), lambda pair: pair[1] - pair[0])]
        newer = "".join(f"\\U{run[0][1]:08x}-\\U{run[-1][1]:08x}" for run in runs)
        self.plain = _pattern(_LETTER, _DIGIT, _OTHER)
        self.differs = re.compile(f"[{newer}]") if newer else None
        self.exact = _pattern(f"[{_LETTER}--[{newer}]]", f"[{_DIGIT}--[{newer}]]", f"(?:{_OTHER}|[{newer}])") if newer else self.plain

    def words(self, text: str) -> list[str]:
        plain = self.differs is None or text.isascii() or self.differs.search(text) is None
        return (self.plain if plain else self.exact).findall(text)


@cache
def splitter() -> Splitter:
    return Splitter()


def prove(vocabulary: str = VOCABULARY) -> Proof:
    """Reads a tokenizer file and finds the vocabulary strings that are one token by themselves."""
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    parts = json.loads(text)
    split = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError("not a byte-level vocabulary without a normalizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"]):
        raise ValueError("added tokens that take in what is beside them")
    model, back = Tokenizer.from_str(text).model, {c: b for b, c in enumerate(byte_letters())}
    whole = []
    for word in parts["model"]["vocab"]:
        if all(c in back for c in word) and len(model.tokenize(word)) == 1:
            try:
                whole.append(bytes(back[c] for c in word).decode())
            except UnicodeDecodeError:
                continue  # part of a character is no pre-token
    return Proof(text, tuple(t["content"] for t in parts["added_tokens"]), frozenset(whole))


class _Tokens(dict):
    """Tokens of pre-tokens: one for the proven strings, and what the merges of others gave."""

    def __init__(self, proof: Proof):
        super().__init__(dict.fromkeys(proof.whole, 1))
        self.whole, self.model = proof.whole, Tokenizer.from_str(proof.file).model

    def __missing__(self, word: str) -> int:
        n = len(self.model.tokenize(spelled(word)))
        if len(word) <= LONGEST_KNOWN:
            if len(self) >= len(self.whole) + KNOWN:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[word] = n
        return n


class Counter:
    """Counts tokens of texts by a proof."""

    def __init__(self, proof: Proof):
        self.tokens, self.split = _Tokens(proof), splitter()
        # the longest of the special strings that start at one place
        special = sorted(proof.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def of_text(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        of_word = self.tokens.__getitem__
        return len(parts) - 1 + sum(sum(map(of_word, self.split.words(s))) for part in parts for s in stretches(part))


_BREAK = regex.compile(r"(?<=\S)\s")


def stretches(text: str, size: int | None = None) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut where white space follows something else."""
    size, at = size or STRETCH, 0
    while len(text) - at > size:
        cut = _BREAK.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _counting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            counts = pa.array([counter.of_text(t.as_py()) for t in text], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.binary_length(text).cast(pa.int64()), counts], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every text."""
    proof = documents.sparkSession.sparkContext.broadcast(prove(vocabulary))
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(_counting(proof), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
