"""Byte-level BPE over a corpus: every distinct word is encoded once.

1. Texts are split into pre-tokens. A block of texts keeps its distinct words and, per text, the
   sequence of word numbers (its words by position).
2. The words are dealt by their hash over all blocks; each part encodes a distinct word once and
   sends the ids back to the blocks that asked. A block asks for a word once, so a word that fills
   a third of all texts is as cheap as any other. The word numbers of a block travel along, so
   that both come from one run over the texts, whichever executors are lost on the way.
3. Per block, ids are joined to the positions and texts are put together; decoding looks ids up in
   the table of token bytes, whose size is that of the vocabulary.

Null and empty texts have no tokens. Repeated rows and repeated or null ids are kept as they are;
other columns of the table are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.llm.blocks import ragged

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BLOCK_CHARS = 12 << 20
PART_BYTES = 4 << 20


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes | None]:
    known = ranks(path)
    table: list[bytes | None] = [None] * (max(known.values()) + 1)
    for word, rank in known.items():
        table[rank] = word
    return table


def pack(values: np.ndarray) -> bytes:
    """Small numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=9).compress(len(words).to_bytes(4, "little") + lengths + b"".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


ROWS = "part int, block string, kind string, payload binary"
SPLIT = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("payload", pa.binary())])


def _splitter(parts: int, block_chars: int):
    """Rows of a block: its texts as word numbers, and its words in one row per part that has any."""
    split = regex.compile(PATTERN)

    def emit(ids: list, texts: list[np.ndarray], words: dict[str, int]) -> pa.RecordBatch:
        # numbers by falling count, so that they compress well
        codes = np.concatenate(texts)
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words))
        spelled = [w.encode() for w in words]
        owner = np.array([xxhash.xxh3_64_intdigest(w) % parts for w in spelled], np.int64)
        known = np.array([i is not None for i in ids]).tobytes()
        numbers = np.array([i or 0 for i in ids], "<i8").tobytes()
        payload = joined(len(words).to_bytes(4, "little"), pack(np.array([len(t) for t in texts])), pack(rank[codes]), known, numbers)
        # a task that runs again gives its blocks the same names
        digest = xxhash.xxh3_64_intdigest(payload)
        block = f"{TaskContext.get().partitionId()}-{digest:x}"
        rows = [(digest % parts, block, "texts", payload)]
        by_part = np.lexsort((rank, owner))
        cuts = np.searchsorted(owner[by_part], np.arange(parts + 1))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            own = by_part[cuts[part] : cuts[part + 1]]
            rows.append((part, block, "words", joined(pack(np.diff(rank[own], prepend=np.uint32(0))), pack_words([spelled[i] for i in own.tolist()]))))
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), SPLIT.types, strict=True)], schema=SPLIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, words, chars = [], [], {}, 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py() or ""
                ids.append(doc.as_py())
                texts.append(np.array([words.setdefault(w, len(words)) for w in split.findall(text)], np.uint32))
                chars += len(text)
                if chars >= block_chars:
                    yield emit(ids, texts, words)
                    ids, texts, words, chars = [], [], {}, 0
        if ids:
            yield emit(ids, texts, words)

    return run


def joined(*blobs: bytes) -> bytes:
    return b"".join([len(blobs).to_bytes(4, "little"), *(len(b).to_bytes(4, "little") for b in blobs), *blobs])


def parted(payload: bytes) -> list[bytes]:
    n = int.from_bytes(payload[:4], "little")
    ends = np.cumsum([4 + 4 * n, *np.frombuffer(payload, "<u4", n, 4).tolist()]).tolist()
    return [payload[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _encoder(path: str):
    """Encodes the words of a part; texts pass through unchanged."""

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        known, spell = {}, encoding(path)._encode_single_piece
        out = []
        for kind, payload in zip(rows["kind"], rows["payload"], strict=True):
            if kind == "words":
                numbers, words = parted(payload)
                ids = []
                for word in unpack_words(words):
                    own = known.get(word)
                    if own is None:
                        own = known[word] = np.array(spell(word), np.uint32).tobytes()
                    ids.append(own)
                payload = joined(numbers, pack(np.array([len(x) // 4 for x in ids], np.uint32)), pack(np.frombuffer(b"".join(ids), np.uint32)))
            out.append(payload)
        return rows.assign(payload=out)

    return encode


def _assembler(path: str, finish: str):
    """Puts the texts of a block together from the ids of its words."""

    def assemble(rows: pd.DataFrame) -> pd.DataFrame:
        numbers, lengths, flat = ([np.zeros(0, np.int64)] for _ in range(3))
        for payload in rows.loc[rows["kind"] == "words", "payload"]:
            steps, *ids = (unpack(blob).astype(np.int64) for blob in parted(payload))
            for to, values in zip((numbers, lengths, flat), (np.cumsum(steps), *ids), strict=True):
                to.append(values)
        numbers, lengths, flat = map(np.concatenate, (numbers, lengths, flat))
        starts = np.cumsum(lengths) - lengths
        numbers, first = np.unique(numbers, return_index=True)  # equal blocks of a task have one name
        starts, lengths = starts[first], lengths[first]
        flat = flat.astype("<u4")
        out = []
        for payload in rows.loc[rows["kind"] == "texts", "payload"]:
            asked, sizes, codes, known, doc_ids = parted(payload)
            if len(numbers) != int.from_bytes(asked, "little"):
                raise ValueError("the rows of the texts changed between two runs of a task")
            sizes, codes = unpack(sizes), unpack(codes)
            ends = np.cumsum(sizes, dtype=np.int64)
            for doc, has, a, b in zip(np.frombuffer(doc_ids, "<i8").tolist(), np.frombuffer(known, bool), ends - sizes, ends, strict=True):
                ids = flat[ragged(starts[codes[a:b]], lengths[codes[a:b]])]
                doc = doc if has else None
                out.append((doc, ids.tobytes()) if finish == "ids" else (doc, *_digests(ids, path)))
        frame = pd.DataFrame(out, columns=["doc_id", "ids"] if finish == "ids" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return frame.assign(doc_id=pd.array([o[0] for o in out], "Int64"))

    return assemble


def _decoded(ids: np.ndarray, path: str) -> bytes:
    table = token_bytes(path)
    return b"".join([table[i] for i in ids.tolist()])


def _digests(ids: np.ndarray, path: str) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(_decoded(ids, path)).hexdigest()


def _assembled(documents, doc_id, text, vocabulary, block_chars, part_bytes, finish, schema) -> DataFrame:
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # texts hold about a quarter of their size in words that are new in their block
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / 4 / part_bytes))
    split = rows.mapInArrow(_splitter(parts, block_chars), ROWS).repartition(parts, "part")
    answered = split.groupBy("part").applyInPandas(_encoder(vocabulary), ROWS)
    return answered.groupBy("block").applyInPandas(_assembler(vocabulary, finish), schema)


def encode(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
    block_chars: int = BLOCK_CHARS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every text."""
    return _assembled(documents, doc_id, text, vocabulary, block_chars, part_bytes, "ids", "doc_id bigint, ids binary")


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_decoded(np.frombuffer(x.as_buffer(), "<u4"), path) if x.is_valid else None for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with the bytes that the ids stand for, as ``decoded``."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(vocabulary), "doc_id bigint, ids binary, decoded binary")


def digest(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
    block_chars: int = BLOCK_CHARS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Number of tokens and digests of the ids and of the bytes they decode to, of every text.

    Ids are decoded where they are put together, so neither they nor the bytes leave the task.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _assembled(documents, doc_id, text, vocabulary, block_chars, part_bytes, "digest", schema)
