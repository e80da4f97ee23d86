"""Importance resampling of a corpus towards a target: words, bucket histograms, gains, noise, ranks.

1. An untrained ``Split`` of the tokenizers library over the text with A-Z lowered gives the words
   with their offsets. A feature is a run of 1 to ``longest`` words, met as a window over the
   offset pairs and joined by one space; its bucket is the CRC-32 of its UTF-8 bytes modulo
   ``buckets``. A text's buckets are written once, as packed numbers, and all later steps read those.
2. Each task counts the buckets of its rows, and the counts meet per bucket: at most ``buckets``
   rows a task, so no word is hot. The same is done for the target.
3. A bucket's gain is the floored logarithm, in thousandths, of its share in the target over its
   share in the corpus, both smoothed by one. The table of gains has one number a bucket, which is
   the bound of what is broadcast. A text's weight is the sum over its features.
4. Weight plus Gumbel noise of the id is the score, and the highest scores among the texts of at
   least ``least`` words are drawn. Ranks are numbered over range slices, never in one task; the
   lowest score that can be drawn is not guessed, as only the slices' sizes decide.

Null and empty texts have no words, no features and weight 0. A null id counts as empty text in the
noise and ranks last among equal scores. Repeated rows are rows of their own: each takes part and
gets a rank of its own, in the order of doc_id, n_features and weight. Texts of any length are taken
whole. An empty corpus gives no rows; an empty target counts nothing and still smooths. Other
columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from vocabweave.operators.keyed import dense_number
from vocabweave.session import cut_lineage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = 2024
#: Words whose bucket a task remembers; the table is emptied when full.
KNOWN = 200_000

_LOWERED = {c: c + 32 for c in range(65, 91)}


class Buckets:
    """Buckets of the features of texts."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.known: dict[str, int] = {}

    def _crc(self, word: str) -> int:
        crc = self.known.get(word)
        if crc is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            crc = self.known[word] = zlib.crc32(word.encode())
        return crc

    def of_text(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each feature: runs of one word first, then of two, and so on."""
        lowered = text.translate(_LOWERED)
        words = self.split.pre_tokenize_str(lowered)
        crcs = [self._crc(word) for word, _ in words]
        features = [crcs]
        for length in range(2, self.longest + 1):
            # a window's sum goes on from that of the window one word shorter
            ends = [b" " + lowered[a:b].encode() for _, (a, b) in words[length - 1 :]]
            features.append([zlib.crc32(end, crc) for end, crc in zip(ends, features[-1], strict=False)])
        flat = np.fromiter((crc for run in features for crc in run), np.int64, sum(map(len, features)))
        return len(words), flat % self.buckets


def _packer(longest: int, buckets: int):
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Buckets(longest, buckets)
        for batch in batches:
            found = [own.of_text(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()),
                    pa.array([f.astype(kind).tobytes() for _, f in found], pa.binary()),
                ],
                names=["doc_id", "n_words", "n_features", "features"],
            )

    return run


def _numbers(value: pa.Scalar, buckets: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<u2" if buckets <= 1 << 16 else "<u4")


def features(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and the packed buckets of every text, written as a table."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(_packer(longest, buckets), "doc_id bigint, n_words bigint, n_features bigint, features binary"))


def histogram(packed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("features"):
                counts += np.bincount(_numbers(value, buckets), minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["bucket", "n"])

    met = packed.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in met.collect():  # one row a bucket
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, from its counts in the corpus and in the target."""
    n, total, wanted = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = [((t + 1) * (total + n)) / ((s + 1) * (wanted + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of an id in thousandths."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def _scorer(shared, buckets: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            weights = [int(table[_numbers(value, buckets)].sum()) for value in batch.column("features")]
            scores = [w + noise(i, seed) for w, i in zip(weights, batch.column("doc_id").to_pylist(), strict=True)]
            rest = [batch.column(name) for name in ("doc_id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def resample(
    documents: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST,
    buckets: int = BUCKETS, least: int = LEAST_WORDS, share: tuple[int, int] = SHARE, seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn) of every document.

    ``share`` is the fraction of the documents of at least ``least`` words that is drawn.
    """
    spark = documents.sparkSession
    packed = features(documents, doc_id=doc_id, text=text, longest=longest, buckets=buckets)
    wanted = features(target.select(F.lit(None).alias("doc_id"), F.col(target_text).alias("text")), longest=longest, buckets=buckets)
    table = spark.sparkContext.broadcast(gains(histogram(packed, buckets), histogram(wanted, buckets)))
    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    # the place in the table tells equal rows apart, so that slices stay even however many there are
    scored = cut_lineage(packed.mapInArrow(_scorer(table, buckets, seed), schema)).withColumn("place", F.monotonically_increasing_id())
    able = scored.where(F.col("n_words") >= least)
    drawn = able.count() * share[0] // share[1]
    order = [(-F.col("score")).alias("falling"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "n_features", "weight", "place"]
    names = ["falling", "unnamed", "doc_id", "n_features", "weight", "place"]
    ranked = dense_number(able.select(*order), names, "rank")
    ranked = ranked.select("doc_id", "n_features", "weight", (-F.col("falling")).alias("score"), F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = scored.where(F.col("n_words") < least).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(rest)
