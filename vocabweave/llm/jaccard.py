"""N-gram Jaccard join: texts whose sets of word shingles overlap by 75 of 100 or more.

1. Each text becomes its set of 5-word shingles, as hashes. Equal sets are one node, however many
   texts have them.
2. Shingles are dealt by their hash in packed blocks and counted over all texts; the counts go
   back to the blocks. Shingles of one text alone cannot be shared: they only take up places at
   the front of the text's rare-first order. A text whose prefix holds nothing else is done.
3. Nodes meet on the shingles of their prefixes. A pair must pass the length filter, the positional
   filter (what can still follow at the place where they meet) and the suffix filter (shared
   shingles counted by 16 ranges of their hash), and is then verified once on the whole sets.
4. Only classes are wanted, so pairs within one class need no look: first every node is verified
   against a centre of one of its shingles, for ``STARS`` rounds with other centres; what is
   connected is one class. Then all pairs of different classes that share a prefix shingle are
   verified. No pair is left out, and a group of near copies costs its size, not its square.

A shingle that many texts of one block share is counted there and not sent once per text; it comes
last in the order of all texts, by its hash.

A text with fewer words than a shingle is one shingle of all its words. Null and empty texts have
an empty set and are linked with nothing. Shingles are told apart by 64-bit hashes of their
words cut to 40 bits and the number of their part, sets by a 64-bit hash. Repeated rows and ids are kept as rows; a null id
counts for no class name. Other columns of the table are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vocabweave.llm.blocks import LOWER, SPACED, Hashes, free_name, shingles, text_blocks, words
from vocabweave.llm.links import components
from vocabweave.session import cut_lineage

SIZE = 5
SIMILARITY = 75
STARS = 2
BLOCK_BYTES = 6 << 20
PART_SHINGLES = 2_000_000
HEAVY = 16
CHUNK = 1000

_LOW = np.uint64((1 << 40) - 1)
LAST = (1 << 31) - 1
#: Keys that a broadcast may hold, 16 bytes each.
FEW = 1_000_000
NODE = "set_of_shingles"


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, SPACED)
    hashes = Hashes(data).of(starts, ends)
    runs = shingles(hashes, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out.append(np.unique(runs[a : b - size + 1]) if b - a >= size else shingles(hashes[a:b], b - a) if b > a else runs[:0])
    return out


def _name(own: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64)) if len(own) else None


def _namer(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_blocks(batch.column("text")):
                own = sets_of(data, offsets, size)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pa.array([_name(s) for s in own], pa.int64()), pa.array([len(s) for s in own], pa.int64()),
                ], names=["doc_id", "node", "n"])

    return run


PACKED = "part int, block string, kind string, payload binary"
_PACKED = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("payload", pa.binary())])


def _press(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed blob; the first tells how to cut it."""
    blobs = [np.ascontiguousarray(a) for a in arrays]
    head = np.array([len(blobs), *(b.nbytes for b in blobs)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(b.tobytes() for b in blobs))


def _unpress(payload: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.cumsum([4 + 4 * n, *np.frombuffer(data, "<u4", n, 4).tolist()]).tolist()
    return [np.frombuffer(data[a:b], kind) for a, b, kind in zip(ends[:-1], ends[1:], kinds, strict=True)]


def _narrow(hashes: np.ndarray) -> np.ndarray:
    """The 5 low bytes of each hash."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).ravel()


def _wide(blob: np.ndarray) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), np.uint8)
    out[:, :5] = blob.reshape(-1, 5)
    return out.view("<u8").ravel()


def _dealer(size: int, parts: int, heavy_from: int):
    """Blocks of texts as packed rows: shingles by part, and the block's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                yield from emit(sets_of(data, offsets, size))

    def emit(own: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        once = {name: s for s in own if (name := _name(s)) is not None}
        if not once:
            return
        nodes, sizes = np.array(list(once), np.int64), np.array([len(s) for s in once.values()], np.int64)
        flat = np.concatenate(list(once.values()))
        part = ((flat >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        short = flat & _LOW
        doc = np.repeat(np.arange(len(nodes)), sizes)
        token = (part << 40) | short.astype(np.int64)
        order = np.argsort(token, kind="stable")
        first = np.flatnonzero(np.diff(token[order], prepend=-1))
        counts = np.diff(np.append(first, len(order)))
        heavy = np.zeros(len(token), bool)
        heavy[order] = np.repeat(counts >= heavy_from, counts)
        heavy_tokens = token[order[first[counts >= heavy_from]]]
        block = f"{TaskContext.get().partitionId()}-{xxhash.xxh3_64_hexdigest(nodes.tobytes())}"
        light = np.flatnonzero(~heavy)
        light = light[np.argsort(part[light], kind="stable")]
        cuts = np.searchsorted(part[light], np.arange(parts + 1))
        heavy_cuts = np.searchsorted(heavy_tokens >> 40, np.arange(parts + 1))
        rows = [(int(nodes[0]) % parts, block, "nodes", _press(nodes, sizes, doc[heavy].astype("<u4"), token[heavy]))]
        for p in range(parts):
            at = light[cuts[p] : cuts[p + 1]]
            marked = heavy_tokens[heavy_cuts[p] : heavy_cuts[p + 1]].astype(np.uint64) & _LOW
            if len(at) or len(marked):
                rows.append((p, block, "shingles", _press(np.diff(doc[at], prepend=0).astype("<u2" if len(nodes) < 65536 else "<u4"), _narrow(short[at]), _narrow(marked))))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _PACKED.types, strict=True)], schema=_PACKED)

    return run


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts the shingles of a part over all blocks; each block gets those that are shared."""
    is_shingles = (rows["kind"] == "shingles").to_numpy()
    blobs = [zstandard.ZstdDecompressor().decompress(p) for p in rows["payload"][is_shingles]]
    own = []
    for data in blobs:
        sizes = np.frombuffer(data, "<u4", 4)
        ends = np.cumsum([16, *sizes[1:].tolist()]).tolist()
        hashes, marked = (np.frombuffer(data[a:b], np.uint8) for a, b in zip(ends[1:-1], ends[2:], strict=True))
        docs = np.frombuffer(data[ends[0] : ends[1]], "<u2" if len(hashes) // 5 * 2 == ends[1] - ends[0] else "<u4")
        own.append((np.cumsum(docs, dtype=np.int64), _wide(hashes), _wide(marked)))
    if not own:
        return rows
    flat = np.concatenate([h for _, h, _ in own])
    marked = np.unique(np.concatenate([m for _, _, m in own]))
    kinds, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    counts[np.isin(kinds, marked)] = LAST
    times = counts[inverse]
    out, at = [], 0
    for docs, hashes, _ in own:
        n = times[at : at + len(hashes)]
        at += len(hashes)
        keep = n > 1
        out.append(_press(docs[keep].astype("<u4"), n[keep].astype("<u4"), _narrow(hashes[keep])))
    payload = rows["payload"].copy()
    payload[is_shingles] = out
    return rows.assign(payload=payload)


def prefix(n):
    """How many of the rarest shingles two sets must meet in, at least once."""
    return n - -(-n * SIMILARITY // 100) + 1


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a block whose prefix holds shared shingles, with all of these, rarest first."""
    out = []
    nodes = sizes = None
    doc, times, token = [], [], []
    for part, kind, payload in zip(rows["part"], rows["kind"], rows["payload"], strict=True):
        if kind == "nodes":
            nodes, sizes, heavy_doc, heavy_token = _unpress(payload, "<i8", "<i8", "<u4", "<i8")
            doc.append(heavy_doc.astype(np.int64))
            times.append(np.full(len(heavy_doc), LAST, np.int64))
            token.append(heavy_token)
        else:
            d, n, h = _unpress(payload, "<u4", "<u4", "u1")
            doc.append(d.astype(np.int64))
            times.append(n.astype(np.int64))
            token.append(_wide(h).astype(np.int64) | (int(part) << 40))
    if nodes is None:
        raise ValueError("the rows of the texts changed between two runs of a task")
    doc, times, token = map(np.concatenate, (doc, times, token))
    once = np.unique(np.stack([doc, token]), axis=1, return_index=True)[1] if len(rows) > len(set(zip(rows["part"], rows["kind"], strict=True))) else np.arange(len(doc))
    doc, times, token = doc[once], times[once], token[once]
    order = np.lexsort((token, times, doc))
    doc, token = doc[order], token[order]
    cuts = np.searchsorted(doc, np.arange(len(nodes) + 1))
    for i, (node, n) in enumerate(zip(nodes.tolist(), sizes.tolist(), strict=True)):
        own = token[cuts[i] : cuts[i + 1]]
        if len(own) and n - len(own) < prefix(n):
            out.append((node, n, own, np.bincount(own & 15, minlength=16).astype(np.int32)))
    return pd.DataFrame(out, columns=["node", "n", "tokens", "spread"])


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough."""
    sides = [nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}"), F.col("spread").alias(f"s_{s}")) for s in "ab"]
    joined = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    total = F.col("n_a") + F.col("n_b")
    least = lambda shared: (100 + SIMILARITY) * shared >= SIMILARITY * total
    bound = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.least(x, y)), F.lit(0).cast("int"), lambda x, y: x + y)
    return joined.where(least(bound)).where(least(F.size(F.array_intersect("t_a", "t_b")))).select("a", "b")


def _fits(n_x, pos_x, n_y, pos_y):
    """Length and positional filter of two places in prefixes."""
    rest = F.least(n_x - pos_x, n_y - pos_y)
    return (100 * F.least(n_x, n_y) >= SIMILARITY * F.greatest(n_x, n_y)) & ((100 + SIMILARITY) * rest >= SIMILARITY * (n_x + n_y))


def classes(nodes: DataFrame, stars: int = STARS) -> DataFrame:
    """``node`` and ``root`` of all nodes that are linked, but the roots, from (node, n, tokens, spread)."""
    kept = F.expr(f"slice(tokens, 1, cast(({100 - SIMILARITY} * n) div 100 + 1 - (n - size(tokens)) as int))")
    places = nodes.select("node", "n", (F.col("n") - F.size("tokens")).alias("before"), F.posexplode(kept).alias("i", "token"))
    places = places.select("token", "node", "n", "before", (F.col("before") + F.col("i")).alias("pos"))
    often = places.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("token")
    places = cut_lineage(places.join(often, "token"))

    links = tested = None
    roots = None

    def placed() -> DataFrame:
        if roots is None:
            return places.withColumn("root", F.col("node"))
        return places.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    for turn in range(stars):
        here = placed()
        # the first centres are those with the fewest shingles of their own: what near copies were made from
        order = F.struct((F.col("before") / F.col("n") if turn == 0 else F.xxhash64(F.lit(turn), "node")).alias("_o"), "node", "n", "pos", "root")
        centre = here.groupBy("token").agg(F.min(order).alias("c"), F.min("root").alias("_low"), F.max("root").alias("_high"))
        centre = centre.where("_low <> _high").select("token", "c.node", "c.n", "c.pos", "c.root")
        ray = here.alias("x").join(centre.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & _fits(*(F.col(f"{t}.{c}") for t in "xy" for c in ("n", "pos"))))
        seen = ray.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count(F.lit(1)).alias("_n"))
        best = seen.groupBy("a").agg(F.max(F.struct("_n", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        if tested is not None:
            best = best.join(tested, ["a", "b"], "left_anti")
        best = cut_lineage(best)
        found = cut_lineage(_verified(best, nodes))
        links = found if links is None else links.union(found)
        both = best.union(best.select("b", "a"))
        tested = both if tested is None else tested.union(both)
        roots = cut_lineage(components(links))

    # all pairs of different classes; on each shingle, one class need not meet itself. The places of
    # a shingle come as lists of about CHUNK nodes by hash, so a pair that shares many shingles
    # is met in one group and put out once
    here = cut_lineage(placed())
    main = here.groupBy("token").agg(F.min("root").alias("main"), F.max("root").alias("_high"), F.count(F.lit(1)).alias("_n")).where("main <> _high")
    mixed = cut_lineage(here.join(main.select("token", "main", "_n"), "token"))
    chunks = max(1, math.ceil((mixed.agg(F.max("_n")).first()[0] or 0) / CHUNK))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.lit(chunks)).alias("chunk")
    lists = mixed.groupBy("token", chunk).agg(F.collect_list(F.struct("node", "n", "pos", "root")).alias("ys"))
    other = mixed.where("root <> main").select("token", "node", "n", "pos", "root", "main")
    partners = F.filter("ys", lambda y: (y["root"] != F.col("root")) & ((y["root"] == F.col("main")) | (F.col("node") < y["node"])) & _fits(F.col("n"), F.col("pos"), y["n"], y["pos"]))
    met = other.join(lists, "token").select("node", "chunk", F.transform(partners, lambda y: y["node"]).alias("ys")).where(F.size("ys") > 0)
    gathered = met.groupBy("node", "chunk").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    pairs = gathered.select(F.col("node").alias("a"), F.explode("ys").alias("b"))
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    rest = cut_lineage(_verified(pairs, nodes))
    return components(rest if links is None else links.union(rest))


def shared_sets(documents: DataFrame, size: int = SIZE, part_shingles: int = PART_SHINGLES, heavy_from: int = HEAVY) -> DataFrame:
    """Distinct sets (node, n, tokens, spread) that may be linked, of (text) rows."""
    length = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(length / 6 / part_shingles))
    dealt = documents.select("text").mapInArrow(_dealer(size, parts, heavy_from), PACKED).repartition(parts, "part")
    counted = dealt.groupBy("part").applyInPandas(_count, PACKED)
    found = counted.groupBy("block").applyInPandas(_gather, "node bigint, n bigint, tokens array<bigint>, spread array<int>")
    return found.dropDuplicates(["node"])


def groups(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, part_shingles: int = PART_SHINGLES,
    heavy_from: int = HEAVY, stars: int = STARS,
) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``node`` (its set), ``n_shingles`` and ``root`` (its class); an empty set has neither."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    members = cut_lineage(rows.mapInArrow(_namer(size), "doc_id bigint, node bigint, n bigint"))
    linked = classes(cut_lineage(shared_sets(rows, size, part_shingles, heavy_from)), stars)
    return members.join(linked, "node", "left").select("doc_id", "node", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("root"))


def join(documents: DataFrame, **settings) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id of its class.

    Settings are those of ``groups``.
    """
    placed = groups(documents, **settings)
    named = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(named, "root", "left").select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _marker(text: str, size: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_name(own) for _, _, data, offsets in text_blocks(batch.column(text)) for own in sets_of(data, offsets, size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=[*batch.schema.names, name])

    return run


def one_of_each(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, few: int = FEW, **settings) -> DataFrame:
    """``documents`` with one row of each class: that of the smallest id. Rows with an empty set all stay.

    Rows that go are looked up by id and set; up to ``few`` of these keys are broadcast, more are joined by a shuffle.
    Null and empty texts and those without words have an empty set. Of rows with one id and one set,
    one stays; a null id comes after all others. An empty table gives an empty one. Texts may have any
    length, and other columns any name.
    """
    rows = groups(documents, doc_id=doc_id, text=text, size=size, **settings).where("node IS NOT NULL")
    pairs = cut_lineage(rows.groupBy("doc_id", "node").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("times")))
    best = pairs.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node", "times")).alias("best"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("node") == F.col("best.node"))
    node, key, of = (free_name(name, documents.columns) for name in (NODE, "id_of_set", "node_of_id"))
    keys = [F.col("doc_id").alias(key), F.col("node").alias(of)]
    gone = cut_lineage(pairs.join(best, "root").where(~stays).select(*keys))
    again = cut_lineage(best.where("best.times > 1").select("best.doc_id", "best.node").select(*keys))

    named = documents.mapInArrow(_marker(text, size, node), StructType([*documents.schema.fields, StructField(node, LongType())]))
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col(key)) & (F.col(node) == F.col(of))
    left = named.join(F.broadcast(gone) if gone.count() <= few else gone, same, "left_anti")
    if not again.isEmpty():
        repeated = left.join(again, same, "left_semi").dropDuplicates([doc_id, node])
        left = left.join(again, same, "left_anti").union(repeated)
    return left.drop(node)
