"""Benchmark decontamination: which words of a document lie in a passage of a benchmark item.

A passage (window) is a run of 13 item words; an item of fewer words is one window. Windows
are sets of word shingles that a document must contain whole, so a prefix of one shingle is
enough: the one that the corpus has least often. Documents look up their shingles among these
prefixes, the place of the shingle in its window bounds where the window must lie in the
document, and every word of the window is then compared.

Items are taken in blocks of bounded size (``block_bytes``), each broadcast in turn, so the
benchmark may be of any size. Shingle counts cover all documents.

Null or empty texts have no words: such documents have no hits, such items no windows. Rows
that are repeated give repeated results. Items without an id are none: their passages count no
hits, as in the SQL twin. Equal item rows are one before blocks are cut. Other columns of either
table are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabweave.llm.blocks import LOWER, PLAIN, Hashes, owners, ragged, shingles, text_blocks, words
from vocabweave.session import cut_lineage

WINDOW = 13
SHINGLE = 5
ITEM_BLOCK_BYTES = 2 << 20


def _shingle(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of word hashes, as ``shingles`` gives it."""
    return shingles(rows.ravel(), rows.shape[1])[:: rows.shape[1]] if len(rows) else np.zeros(0, np.uint64)


class Windows:
    """The distinct windows of a block of items, and the shingles to look for."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int, shingle: int):
        found = [(np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for first, _, data, offsets in text_blocks(pa.array(texts, pa.string())):
            data = LOWER[data]
            starts, ends, bounds = words(data, offsets, PLAIN)
            hashes = np.append(Hashes(data).of(starts, ends), np.zeros(window, np.uint64))
            n = np.diff(bounds)
            count = np.where(n > 0, np.maximum(n - window + 1, 1), 0)
            item = np.repeat(np.arange(len(n)), count)
            size = np.minimum(n, window)[item]
            at = ragged(bounds[:-1], count)[:, None] + np.arange(window)
            found.append((np.where(np.arange(window) < size[:, None], hashes[at], 0), size, item + first))
        rows, sizes, item = map(np.concatenate, zip(*found, strict=True))
        # equal windows are one: sorted as bytes together with their size
        keys = np.ascontiguousarray(np.c_[rows, sizes.astype(np.uint64)]).view(np.dtype((np.void, 8 * (window + 1)))).ravel()
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.ids, self.words, self.sizes = ids, rows[first], sizes[first]
        owned = np.unique(np.stack([inverse, item]), axis=1) if len(item) else np.zeros((2, 0), np.int64)
        self.items = owned[1]
        self.item_counts = np.bincount(owned[0], minlength=len(first))
        self.item_starts = np.cumsum(self.item_counts) - self.item_counts
        # shingles of each window: (hash, window, place); a short window is one shingle
        self.widths = sorted({min(shingle, int(s)) for s in np.unique(self.sizes)})
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for size in np.unique(self.sizes).tolist():
            own, width = np.flatnonzero(self.sizes == size), min(shingle, size)
            for at in range(size - width + 1):
                hashes = _shingle(self.words[own, at : at + width])
                parts.append((hashes, own, np.full(len(own), at)))
        self.hash, self.window, self.place = map(np.concatenate, zip(*parts, strict=True))
        self.distinct = np.unique(self.hash)

    def keep_prefixes(self, counts: dict[int, int]) -> None:
        """Keep each window's rarest shingle; a window with one that no document has can't occur."""
        known = np.zeros(len(self.distinct), np.int64)
        known[list(counts)] = list(counts.values())
        n = known[np.searchsorted(self.distinct, self.hash)]
        order = np.lexsort((self.place, self.hash, n, self.window))
        first = order[np.flatnonzero(np.diff(self.window[order], prepend=-1))] if len(order) else order
        first = first[n[first] > 0]
        first = first[np.argsort(self.hash[first], kind="stable")]
        self.hash, self.window, self.place = self.hash[first], self.window[first], self.place[first]
        self.distinct = np.unique(self.hash)


def _marks(distinct: np.ndarray) -> np.ndarray:
    marks = np.zeros(1 << 18, bool)
    marks[(distinct & np.uint64(0x3FFFF)).astype(np.int64)] = True
    return marks


def _sightings(data, offsets, widths, distinct, marks):
    """Words of a block and (position, index of the shingle) of every sought shingle in it."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, PLAIN)
    hashes = Hashes(data).of(starts, ends)
    end = np.repeat(bounds[1:], np.diff(bounds))
    at, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width in widths:
        own = shingles(hashes, width)
        near = np.flatnonzero(marks[(own & np.uint64(0x3FFFF)).astype(np.int64)])
        near = near[near + width <= end[near]]
        spot = np.searchsorted(distinct, own[near])
        same = (spot < len(distinct)) & (distinct[np.minimum(spot, len(distinct) - 1)] == own[near])
        at.append(near[same])
        which.append(spot[same])
    return hashes, bounds, np.concatenate(at), np.concatenate(which)


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        marks = _marks(windows.distinct)
        totals = np.zeros(len(windows.distinct), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text")):
                which = _sightings(data, offsets, windows.widths, windows.distinct, marks)[3]
                totals += np.bincount(which, minlength=len(totals))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["shingle", "n"])

    return count


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        marks = _marks(windows.distinct)
        lows = np.searchsorted(windows.hash, windows.distinct)
        counts = np.searchsorted(windows.hash, windows.distinct, "right") - lows
        for batch in batches:
            for i, j, data, offsets in text_blocks(batch.column("text")):
                yield one(windows, marks, lows, counts, batch.slice(i, j - i), data, offsets)

    def one(windows, marks, lows, counts, batch, data, offsets):
        hashes, bounds, at, which = _sightings(data, offsets, windows.widths, windows.distinct, marks)
        entry = ragged(lows[which], counts[which])
        at = np.repeat(at, counts[which])
        doc = np.searchsorted(bounds, at, "right") - 1
        window, start = windows.window[entry], at - windows.place[entry]
        size = windows.sizes[window]
        fits = (start >= bounds[doc]) & (start + size <= bounds[doc + 1])
        doc, window, start, size = doc[fits], window[fits], start[fits], size[fits]
        same = np.ones(len(start), bool)
        for k in range(windows.words.shape[1]):
            there = hashes[np.minimum(start + k, max(len(hashes) - 1, 0))] if len(hashes) else np.zeros(0, np.uint64)
            same &= (k >= size) | (there == windows.words[window, k])
        doc, window, start, size = doc[same], window[same], start[same], size[same]

        # words inside any occurrence, together with those found for earlier blocks of items
        depth = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(depth, start, 1)
        np.add.at(depth, start + size, -1)
        hit = np.cumsum(depth)[:-1] > 0
        old = batch.column("items").to_pylist()
        for k, (a, b) in enumerate(zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True)):
            for x, y in zip(a, b, strict=True):
                hit[bounds[k] + x : bounds[k] + y] = True
        edge = np.zeros(len(hashes) + 1, bool)
        edge[bounds] = True
        run_start = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]]))) if len(hit) else np.zeros(0, np.int64)
        run_end = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1 if len(hit) else np.zeros(0, np.int64)
        cuts = np.searchsorted(run_start, bounds)
        base = bounds[owners(cuts)]
        n_hit = np.concatenate([[0], np.cumsum(hit)])[bounds]

        item = windows.items[ragged(windows.item_starts[window], windows.item_counts[window])]
        pairs = np.unique(np.stack([np.repeat(doc, windows.item_counts[window]), item]), axis=1)
        for d, k in pairs.T.tolist():
            old[d].append(windows.ids[k])
        lists = lambda values: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64()))
        found = {
            "n_words": pa.array(np.diff(bounds)), "n_hit": pa.array(np.diff(n_hit)), "starts": lists(run_start - base),
            "ends": lists(run_end - base), "items": pa.array([sorted(set(x)) for x in old], pa.list_(pa.string())),
        }
        names = batch.schema.names
        return pa.RecordBatch.from_arrays([found.get(name, batch.column(name)) for name in names], names=names)

    return find


def passages(
    documents: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = ITEM_BLOCK_BYTES, carry: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, the hit runs of words (``starts``, ``ends``) and the ``items``.

    Item ids are compared as text. The result also holds ``text`` and the columns named in
    ``carry``, these as the fields of a struct ``carried``.
    """
    spark = documents.sparkSession
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    state = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"), empty("bigint").alias("starts"), empty("bigint").alias("ends"), empty("string").alias("items"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("words")).where("item IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("words") + F.lit(16))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).orderBy("item", "words").collect()
        windows = Windows([r.item for r in rows], [r.words for r in rows], window, shingle)
        if len(windows.distinct):
            sought = spark.sparkContext.broadcast(windows)
            counted = state.select("text").mapInArrow(_counter(sought), "shingle bigint, n bigint")
            counts = {r.shingle: r.n for r in counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}
            windows.keep_prefixes(counts)
        if block:
            state = cut_lineage(state)
        state = state.mapInArrow(_finder(spark.sparkContext.broadcast(windows)), state.schema)
    return state


def contaminated(found: DataFrame) -> DataFrame:
    """``passages`` with the decision: at least one word in twenty lies in a passage."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(found: DataFrame) -> DataFrame:
    listed = F.concat_ws(",", F.array_sort("items"))
    return contaminated(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), "contaminated"
    )
