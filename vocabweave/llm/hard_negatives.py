"""Hard negatives by an inverted multi-index: half-space codebooks, cells, certified windows.

1. Components become integers, so all inner products are exact. Two codebooks, one for each half of
   the components, are fitted on a bounded sample (``SAMPLE`` rows, those of the least hash); every
   row is indexed. The pair of nearest codewords is a row's cell. The index is range-partitioned by
   cell and id, so a cell that holds a third of all rows lies in many files.
2. Anchors are searched in blocks of ``ANCHOR_BYTES``, which are broadcast; each task reads its part of
   the index in chunks of ``CHUNK_BYTES``. In a chunk, the half-scores of an anchor and a codeword, plus
   the length of the half anchor times the radius of the codeword's rows, bound what its rows can
   score; a heap walks over the pairs of both sequences by falling sum of these bounds (the
   multi-sequence algorithm) and reads the cells in that order. It ends when the bound is below what
   the anchor still needs, which certifies that no row was missed: the result is exact.
3. The first search finds the positives: the best rows of the anchor's label. The second one knows
   their scores, so each (anchor, positive) has a window of scores for its negatives. Cells that lie
   wholly above all windows are passed over; the heap ends below the worst negative still needed.
4. A task keeps and returns at most as many rows per anchor or window as are asked for; the best of
   all tasks are taken per anchor. So rows that meet follow the number of anchors and of tasks,
   not of rows; only scores, never vectors, are shuffled, and a lost task reads its part again.

Rows without an id or label, and vectors that are null or hold null or non-finite components, take
no part, nor do vectors that are not as long as most are (of the commonest lengths, the longest).
Repeated rows count once. Rows with one id and different vectors or labels are rows of their own; a
row is never a positive of an anchor of its id. Ties go to the smaller id. A negative positive score
has an empty window; an anchor without positives, or a window without rows, gives no rows, as does
an empty table. Integers beyond 32 bits and inner products beyond 64 bits are refused. Other
columns are ignored whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.session import cut_lineage, shared_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this fraction of the positive.
LEAST = (80, 100)
SAMPLE = 4096
ROWS_PER_CELL = 256
MOST_CODEWORDS = 256
ANCHOR_BYTES = 4 << 20
CHUNK_BYTES = 8 << 20
#: Rows of the next cells that are scored together.
BATCH_ROWS = 512

INDEX = "c1 int, c2 int, vec_id bigint, label bigint, vector binary"


def codebook(points: np.ndarray, codewords: int) -> np.ndarray:
    """Centres of a few rounds of k-means from spread starting points."""
    distinct = np.unique(points, axis=0)
    codewords = min(codewords, len(distinct))
    centres = distinct[np.random.default_rng(11).choice(len(distinct), codewords, replace=False)].astype(np.float64)
    for _ in range(8):
        near = nearest(points, centres)
        for k in range(codewords):
            if (near == k).any():
                centres[k] = points[near == k].mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each point."""
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = vectors.shape[1] // 2
    return vectors[:, :middle], vectors[:, middle:]


def _integers(column: pa.Array, scale: int) -> np.ndarray:
    """Floored multiples of the components, a row each."""
    values = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * values)
    if len(whole) and np.abs(whole).max() >= 1 << 31:
        raise OverflowError("a component does not fit into 32 bits")
    return whole


def _indexer(books: tuple[np.ndarray, np.ndarray], scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            whole = _integers(batch.column("vector"), scale)
            codes = [nearest(half, book).astype(np.int32) for half, book in zip(_halves(whole), books, strict=True)]
            packed = pa.array([row.tobytes() for row in whole.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[0]), pa.array(codes[1]), batch.column("vec_id"), batch.column("label"), packed], names=["c1", "c2", "vec_id", "label", "vector"]
            )

    return run


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.float64)


def _scores(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exact."""
    if not len(vectors):
        return np.zeros(0, np.int64)
    most = float(np.abs(vectors).max()) * float(np.abs(one).max()) * len(one)
    if most < 1 << 53:
        return (vectors @ one).astype(np.int64)
    if most >= 1 << 63:
        raise OverflowError("an inner product may not fit into 64 bits")
    return vectors.astype(np.int64) @ one.astype(np.int64)


class Chunk:
    """Some rows of the index by cell, with the bounds of what their cells can score."""

    def __init__(self, books, c1, c2, ids, labels, vectors):
        order = np.lexsort((ids, c2, c1))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        codes = [c1[order], c2[order]]
        fresh = np.flatnonzero(np.r_[True, (np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0)])
        self.starts, self.ends = fresh, np.r_[fresh[1:], len(order)]
        self.centres, self.radii, at = [], [], []
        for half, book, code in zip(_halves(self.vectors), books, codes, strict=True):
            own, place = np.unique(code, return_inverse=True)
            radius = np.zeros(len(own))
            np.maximum.at(radius, place, np.sqrt(((half - book[code]) ** 2).sum(1)))
            self.centres.append(book[own])
            self.radii.append(radius)
            at.append(place[fresh])
        self.cell = np.full((len(self.radii[0]), len(self.radii[1])), -1)
        self.cell[at[0], at[1]] = np.arange(len(fresh))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: the least and the most that an anchor can score with a codeword's rows."""
        out = []
        for half, centres, radii in zip(_halves(anchors), self.centres, self.radii, strict=True):
            middle, reach = half @ centres.T, np.sqrt((half**2).sum(1))[:, None] * radii
            # room for rounding
            reach = reach + 1e-6 + 1e-9 * (np.abs(middle) + reach)
            out.append((middle - reach, middle + reach))
        return out


def visit(chunk: Chunk, low: list[np.ndarray], high: list[np.ndarray], need) -> Iterator[np.ndarray]:
    """Rows of the cells by falling bound, some cells at a time, down to the score ``need()[0]``.

    Cells of which all rows score above ``need()[1]`` are passed over.
    """
    order = [np.argsort(-h, kind="stable") for h in high]
    ranked = [h[o].tolist() for h, o in zip(high, order, strict=True)]
    codes = [o.tolist() for o in order]
    heap = [(-(ranked[0][0] + ranked[1][0]), 0, 0)]
    least, most = need()
    rows, waiting = [], 0
    while heap and -heap[0][0] >= least:
        bound, i, j = heapq.heappop(heap)
        # every pair is reached once: along the second sequence, and along the first from its head
        if j + 1 < len(ranked[1]):
            heapq.heappush(heap, (-(ranked[0][i] + ranked[1][j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(ranked[0]):
            heapq.heappush(heap, (-(ranked[0][i + 1] + ranked[1][0]), i + 1, 0))
        a, b = codes[0][i], codes[1][j]
        cell = chunk.cell[a, b]
        if cell < 0 or low[0][a] + low[1][b] > most:
            continue
        rows.append(np.arange(chunk.starts[cell], chunk.ends[cell]))
        waiting += len(rows[-1])
        if waiting >= BATCH_ROWS:
            yield np.concatenate(rows)
            rows, waiting = [], 0
            least, most = need()
    if rows:
        yield np.concatenate(rows)


@dataclass
class Best:
    """The best (score, id) found so far within a window of scores."""

    most: int
    low: float = -math.inf
    high: float = math.inf
    found: list[tuple[int, int]] = field(default_factory=list)

    def need(self) -> float:
        """A row that scores less is of no use."""
        return self.low if len(self.found) < self.most else max(self.low, -self.found[-1][0])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = np.flatnonzero((scores >= self.need()) & (scores <= self.high))
        if len(use) > self.most:
            use = use[np.lexsort((ids[use], -scores[use]))[: self.most]]
        if len(use):
            self.found = sorted([*self.found, *zip((-scores[use]).tolist(), ids[use].tolist(), strict=True)])[: self.most]


@dataclass
class Anchors:
    """A block of anchors; ``windows`` are the scores of the positives, best first, once they are known."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positives: int
    negatives: int
    least: tuple[int, int]
    windows: list[list[tuple[int, int]]] | None = None

    def wanted(self, k: int) -> list[Best]:
        if self.windows is None:
            return [Best(self.positives)]
        part, whole = self.least
        # smallest integer score that reaches the fraction of the positive's
        return [Best(self.negatives, -(-part * score // whole), score) for _, score in self.windows[k]]


def _need(wanted: list[Best]):
    open_ = [w for w in wanted if w.low <= w.high]
    return lambda: (min((w.need() for w in open_), default=math.inf), max((w.high for w in open_), default=-math.inf))


def _searcher(shared, books):
    """Each task's best rows for each anchor (first search) or each of its windows (second search)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        wanted = [anchors.wanted(k) for k in range(len(anchors.ids))]
        for chunk in _chunks(batches, books):
            (low1, high1), (low2, high2) = chunk.bounds(anchors.vectors)
            for k, own in enumerate(wanted):
                label, one = anchors.labels[k], anchors.vectors[k]
                for rows in visit(chunk, [low1[k], low2[k]], [high1[k], high2[k]], _need(own)):
                    ids, labels = chunk.ids[rows], chunk.labels[rows]
                    use = (labels == label) & (ids != anchors.ids[k]) if anchors.windows is None else labels != label
                    rows = rows[use]
                    scores = _scores(chunk.vectors[rows], one)
                    for best in own:
                        best.add(scores, ids[use])
        out = [(k, w, i, -s) for k, own in enumerate(wanted) for w, best in enumerate(own) for s, i in best.found]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "positive", "vec_id", "score"])

    return run


FOUND = "anchor int, positive int, vec_id bigint, score bigint"


def _chunks(batches: Iterator[pa.RecordBatch], books) -> Iterator[Chunk]:
    def chunk() -> Chunk:
        table = pa.Table.from_batches(waiting)
        columns = [table.column(name).combine_chunks().to_numpy() for name in ("c1", "c2", "vec_id", "label")]
        return Chunk(books, *columns, _vectors(table.column("vector")))

    waiting, size = [], 0
    for batch in batches:
        if len(batch):
            waiting.append(batch)
            size += len(batch) * len(batch.column("vector")[0].as_buffer())
        if size >= CHUNK_BYTES:
            yield chunk()
            waiting, size = [], 0
    if waiting:
        yield chunk()


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    embeddings: DataFrame, is_anchor: Column, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: tuple[int, int] = LEAST,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``is_anchor`` is a condition on ``vec_id`` (a column of that name). Negatives score between
    ``least`` (a fraction) of the positive's score and that score.
    """
    spark = embeddings.sparkSession
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = embeddings.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine & (F.size("vector") > 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("vector") == lengths.length)

    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "label").limit(SAMPLE).select("vector").toArrow()
    codewords = min(MOST_CODEWORDS, max(1, round(math.sqrt(lengths["count"] / ROWS_PER_CELL))))
    books = tuple(codebook(half, codewords) for half in _halves(_integers(sample.column("vector").combine_chunks(), scale)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = rows.mapInArrow(_indexer(books, scale), INDEX).distinct().repartitionByRange(parts, "c1", "c2", "vec_id").sortWithinPartitions("c1", "c2", "vec_id")
    index = cut_lineage(index)

    chosen = index.where(is_anchor).select("vec_id", "label", "vector")
    blocks = math.ceil(chosen.count() * lengths.length * 4 / ANCHOR_BYTES)
    if not blocks:
        return spark.createDataFrame([], result)
    folder = shared_folder(spark, "negatives")
    for block in range(blocks):
        # a block has about ANCHOR_BYTES, whatever the size of the table
        own = chosen.where(F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)) == block).toArrow()
        ids, labels = (own.column(name).to_numpy() for name in ("vec_id", "label"))
        vectors = _vectors(own.column("vector")) if len(ids) else np.zeros((0, lengths.length))
        _mine_block(spark, index, Anchors(ids, labels, vectors, positives, negatives, least), books).write.mode("append").parquet(folder)
    return spark.read.schema(result).parquet(folder)


def _mine_block(spark, index: DataFrame, anchors: Anchors, books) -> DataFrame:
    context = spark.sparkContext
    found = _best(index.mapInArrow(_searcher(context.broadcast(anchors), books), FOUND), anchors.positives).collect()  # a few rows an anchor
    anchors.windows = [[] for _ in anchors.ids]
    for r in sorted(found, key=lambda r: (r.anchor, r.rank)):
        anchors.windows[r.anchor].append((r.vec_id, r.score))
    pairs = [(k, w, int(anchors.ids[k]), i, s) for k, own in enumerate(anchors.windows) for w, (i, s) in enumerate(own)]
    named = spark.createDataFrame(pairs, "anchor int, positive int, anchor_id bigint, positive_id bigint, positive_score bigint")
    negatives = _best(index.mapInArrow(_searcher(context.broadcast(anchors), books), FOUND), anchors.negatives)
    return negatives.join(F.broadcast(named), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
