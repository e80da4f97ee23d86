"""Language identification with language-bitmask n-gram filters.

Each language's frequent n-grams (3 and 4 bytes of lower-cased text, everything in ASCII that is no
letter taken as a blank) go into one bit-sliced Bloom filter: a slot holds a bit per language, and
the ``and`` of an n-gram's slots gives all languages that contain it. For a text, the n-grams that
each language contains are counted, the count is corrected for the language's false positives,
which its share of set bits gives, and the language with most decides. The score is its share of
the two largest counts, 0.5 to 1; it is 0 where nothing was found.

The filter is fitted on at most ``SAMPLE`` texts a language, chosen by a hash of their key, and
keeps the ``GRAMS`` most frequent n-grams of each; its size depends on these alone. Every whole text is
judged. Null, empty and letterless texts are ``und``; a text without any known n-gram goes to the
language with most labelled texts, and without labelled texts all are ``und``. Null languages
teach nothing; repeated rows get repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vocabweave.llm.blocks import mix, owners, ragged, text_blocks

SAMPLE = 600
GRAMS = 15_000
SIZES = (3, 4)
PROBES = 2
SLOT_BITS = 19
LEAST = 3
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 256)
_LETTER = regex.compile(r"\p{L}")


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: the n-grams of a block (bytes and size as one number) and where each text's begin."""
    spaced = np.full(len(data) + len(offsets), 0x20, np.uint8)
    lengths = np.diff(offsets)
    edges = offsets + np.arange(len(offsets))  # the blank in front of each text, and the last one
    spaced[ragged(edges[:-1] + 1, lengths)] = _FOLD[data]
    wide = spaced.astype(np.uint64)
    for size in SIZES:
        value = np.full(max(len(wide) - size + 1, 0), size, np.uint64)
        for k in range(size):
            value = (value << np.uint64(8)) | wide[k : k + len(value)]
        # a text's n-grams may begin with the blank in front of it and end with the one behind it
        count = np.maximum(lengths + 2 - size + 1, 0)
        yield value[ragged(edges[:-1], count)], np.concatenate([[0], np.cumsum(count)])


def _slots(value: np.ndarray) -> list[np.ndarray]:
    spread = mix(value)
    return [((spread >> np.uint64(SLOT_BITS * p)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for p in range(PROBES)]


@dataclass
class Filter:
    languages: list[str]
    #: One table of 64 languages each.
    tables: list[np.ndarray]
    false_positive: np.ndarray

    @classmethod
    def of(cls, known: dict[str, np.ndarray]) -> Filter:
        tables = [np.zeros(1 << SLOT_BITS, np.uint64) for _ in range(-(-len(known) // 64))]
        shares = []
        for k, own in enumerate(known.values()):
            bit = np.uint64(1 << k % 64)
            for slot in _slots(own):
                tables[k // 64][slot] |= bit
            shares.append(np.count_nonzero(tables[k // 64] & bit) / (1 << SLOT_BITS))
        return cls(list(known), tables, np.array(shares) ** PROBES)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected number of n-grams per text and language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        for value, bounds in grams(data, offsets):
            slots, owner = _slots(value), owners(bounds)
            for t, table in enumerate(self.tables):
                mask = table[slots[0]]
                for slot in slots[1:]:
                    mask &= table[slot]
                for k in range(64 * t, min(64 * t + 64, len(self.languages))):
                    has = (mask & np.uint64(1 << k % 64)) != 0
                    hits = np.bincount(owner[has], minlength=len(out))
                    out[:, k] += (hits - np.diff(bounds) * self.false_positive[k]) / (1 - self.false_positive[k])
        return np.maximum(out, 0)


def _frequent(rows: pd.DataFrame) -> pd.DataFrame:
    """The most frequent n-grams of one language's texts."""
    column = pa.array(rows["text"], pa.string())
    found = {}
    for _, _, data, offsets in text_blocks(column):
        for value, _ in grams(data, offsets):
            kinds, counts = np.unique(value, return_counts=True)
            for kind, count in zip(kinds.tolist(), counts.tolist(), strict=True):
                found[kind] = found.get(kind, 0) + count
    least = LEAST if len(rows) >= 10 else 1
    best = sorted((g for g in found if found[g] >= least), key=lambda g: (-found[g], g))[:GRAMS]
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "grams": [np.array(sorted(best), np.int64).tobytes()]})


def fit(documents: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Filter:
    known = documents.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL")
    totals = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("key").cast("string")), "key")
    chosen = known.where("key IS NOT NULL").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE).select("key", "lang")
    texts = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen.distinct()), "key")  # at most SAMPLE rows a language
    found = {r.lang: np.frombuffer(r.grams, np.int64).astype(np.uint64) for r in rows.groupBy("lang").applyInPandas(_frequent, "lang string, grams binary").collect()}
    return Filter.of({name: found[name] for name in sorted(found, key=lambda n: (-totals[n], n))})


def predict(texts: DataFrame, model: Filter, *, text: str = "text", to: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``texts`` with the predicted language and its score."""
    if set(to) & set(texts.columns):
        raise ValueError(f"{to} are already columns")
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i, j, data, offsets in text_blocks(batch.column(text)):
                rows = batch.slice(i, j - i)
                names, scores = [UNKNOWN] * (j - i), np.zeros(j - i)
                if own.languages:
                    counts = own.counts(data, offsets)
                    best = counts.argmax(1)
                    top = counts.max(1)
                    second = np.sort(counts, 1)[:, -2] if counts.shape[1] > 1 else np.zeros(j - i)
                    for k, value in enumerate(rows.column(text)):
                        if value.is_valid and _LETTER.search(value.as_py()):
                            names[k] = own.languages[best[k]]
                            scores[k] = top[k] / (top[k] + second[k]) if top[k] > 0 else 0.0
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*batch.schema.names, *to])

    return texts.mapInArrow(run, StructType([*texts.schema.fields, StructField(to[0], StringType()), StructField(to[1], DoubleType())]))
