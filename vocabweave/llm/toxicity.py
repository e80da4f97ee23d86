"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on the words that toxic texts
hold more often than ordinary ones. A window is one word between two fixed marks that both
dictionaries know (zstandard finds no match in the last bytes of its input, and stores what saves
too little). Its distance is the compressed length under the ordinary dictionary less that under
the toxic one, which is followed by the ordinary text as well, so that only toxic wording counts.
A text is judged by how many of its windows reach each distance, with weights and a prior that
are calibrated on labelled texts; 0.7 and more is toxic.

``fit`` uses at most ``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` labelled rows, chosen by a hash of
their key, and all labels for the prior. ``score`` reads every whole text; each distinct word of a
task is compressed once. Null and empty texts have no windows and get the score of that. Rows
without a label are no examples. If a class has no example, every text gets the share of toxic
labels. Repeated rows get repeated results.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

TOXIC_SAMPLE = 1000
ORDINARY_SAMPLE = 2500
THRESHOLD = 0.7

DICTIONARY_BYTES = 4096
LEVEL = 12
DISTANCES = range(1, 8)
MIN_Z = 4.5
KEPT_WORDS = 150_000

_MARK = bytes(range(0x30, 0x50))
_GAPS = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return _GAPS.sub(b" ", (text or "").lower().encode()).split()


def fragments(word: bytes) -> list[bytes]:
    """A word and its beginnings, with the gap before it."""
    return [b" " + word + b" ", *(b" " + word[:k] for k in range(4, min(len(word), 10) + 1))]


def _trained(samples: list[bytes]) -> bytes:
    """Content of a dictionary; with too few samples to train one, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content + _MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    lean = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    return zstandard.ZstdCompressor(dict_data=known, compression_params=lean)


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0
    _distances: dict[bytes, int] = field(default_factory=dict, repr=False)
    _pair: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_distances": {}, "_pair": None}

    def distance(self, word: bytes) -> int:
        found = self._distances.get(word)
        if found is None:
            if self._pair is None:
                self._pair = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
            if len(self._distances) >= KEPT_WORDS:
                self._distances = {}
            window = _MARK + b" " + word + b" " + _MARK
            found = self._distances[word] = len(self._pair[0].compress(window)) - len(self._pair[1].compress(window))
        return found

    def forget(self) -> None:
        """Gives back the memory of the words seen."""
        self._distances, self._pair = {}, None

    def features(self, counted: dict[bytes, int]) -> list[float]:
        reached = Counter()
        for word, n in counted.items():
            reached[min(self.distance(word), DISTANCES[-1])] += n
        total = sum(reached.values())
        out, so_far = [], 0
        for distance in reversed(DISTANCES):
            so_far += reached[distance]
            out += [np.log1p(so_far), np.sqrt(so_far / max(total, 1))]
        return [*out, np.log1p(total)]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.constant
        x = (np.array(self.features(Counter(words(text)))) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40))))


def _surprise(toxic: int, ordinary: int, n_toxic: int, n_ordinary: int) -> float:
    """How many standard errors the share of toxic texts is above that of ordinary ones."""
    p = (toxic + ordinary) / (n_toxic + n_ordinary)
    spread = max(p * (1 - p), 1e-12) * (1 / n_toxic + 1 / n_ordinary)
    return (toxic / n_toxic - ordinary / n_ordinary) / spread**0.5


def _telling(counted: list[Counter], labels: np.ndarray) -> set[bytes]:
    """Words that begin with a fragment which toxic texts use more, beyond those already found."""
    sides = [Counter(), Counter()]
    for own, label in zip(counted, labels, strict=True):
        sides[label].update({f for w in own for f in fragments(w)})
    sizes = int(labels.sum()), int((1 - labels).sum())
    least = max(2, min(5, sizes[0] // 10))
    wanted = {f for f, n in sides[1].items() if n >= least and _surprise(n, sides[0][f], *sizes) >= MIN_Z}
    uses = defaultdict(set)
    for i, own in enumerate(counted):
        for w in own:
            for f in wanted.intersection(fragments(w)):
                uses[f].add((i, w))
    found: set[bytes] = set()
    while uses:
        ranked = []
        for f in list(uses):
            texts = {i for i, w in uses[f] if w not in found}
            toxic = int(sum(labels[i] for i in texts))
            z = _surprise(toxic, len(texts) - toxic, *sizes)
            if toxic < least or z < MIN_Z:
                del uses[f]
            else:
                ranked.append((-z, len(f), f))
        if ranked:
            found |= {w for _, w in uses.pop(min(ranked)[2])}
    return found


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit with a small penalty; the last one is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.r_[np.ones(x.shape[1] - 1), 1e-6]
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * weights)
    return weights


def fit(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learned from ``documents`` and their ``labels``, which share the column ``key``."""
    ids = documents.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label IN (0, 1)").join(ids, "key")
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return Model(constant=float(totals.get(1, 0) > 0))
    # the sample is chosen by ids alone, then its texts are looked up
    order = F.xxhash64(F.col("key").cast("string"))
    picked = [known.where(F.col("label") == value).orderBy(order, "key").limit(most) for value, most in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))]
    texts_of = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    chosen = texts_of.join(F.broadcast(picked[0].union(picked[1])), "key").collect()  # at most the two samples
    chosen.sort(key=lambda r: (-r.label, r.text or ""))
    texts, labels = [r.text for r in chosen], [r.label for r in chosen]
    y = np.array(labels)
    shared: dict[bytes, bytes] = {}
    counted = [Counter(shared.setdefault(w, w) for w in words(t)) for t in texts]

    telling = _telling(counted, y)
    plain = [b" ".join(own[i : i + 10]) for t, v in zip(texts, labels, strict=True) if not v for own in [words(t)] for i in range(0, len(own), 40)]
    found = [b" " + w + b" " for own, v in zip(counted, labels, strict=True) if v for w, n in own.items() if w in telling for _ in range(n)]
    model = Model(_trained([p for p in plain if p]), _trained(found) if found else b"")
    x = np.array([model.features(own) for own in counted])
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = _calibrated((x - model.mean) / model.scale, y)
    # the sample has other shares of the classes than the labels
    model.weights[-1] += np.log(totals[1] / totals[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return model


def score(texts: DataFrame, model: Model, *, text: str = "text", to: str = "score") -> DataFrame:
    """``texts`` with the column ``to``: 0 to 1, higher for text that is likelier toxic."""
    if to in texts.columns:
        raise ValueError(f"{to} is already a column")
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = pa.array([own.score(t.as_py()) for t in batch.column(text)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, to])
        own.forget()

    return texts.mapInArrow(run, StructType([*texts.schema.fields, StructField(to, DoubleType())]))
