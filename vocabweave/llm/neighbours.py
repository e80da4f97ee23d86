"""Approximate nearest neighbours by inner product, along shifted space-filling curves.

1. Equal vectors become one, with their smallest ids (more than are asked for can't be among the
   nearest), so a vector that a third of all rows share is searched once.
2. Every vector gets a key in each of several orderings: an own random projection to a few
   dimensions, an own shift, and the place on the Hilbert curve of that grid. Spark range-partitions
   the keys, which gives each vector its rank in each ordering.
3. A query meets the vectors at most ``window`` ranks away in any ordering. Ranks are cut into
   blocks; a query goes to the blocks that its window touches, each block scores its own part of
   the window in double precision and keeps the nearest, and these are merged per query.
4. The window is fitted: for a bounded sample of ``SAMPLE`` queries the true neighbours are found by
   brute force, and the window is the smallest that would reach ``TARGET`` of them. Vectors without
   structure need a window that is a large share of the table; clustered ones a narrow one.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without an id and vectors that are not as long as most are. Repeated rows count once. An id with
several vectors is searched with each of them and never found by itself. Fewer candidates than
asked for give all of them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabweave.operators.keyed import dense_number
from vocabweave.session import cut_lineage

ORDERINGS = 4
DIMENSIONS = 8
BITS = 7
SAMPLE = 48
TARGET = 0.96
MARGIN = 1.1
MIN_WINDOW = 64
MIN_BLOCK, MAX_BLOCK = 512, 4096


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``grid`` (cells of 0 .. 2**bits - 1)."""
    x = grid.T.astype(np.uint64).copy()
    n = len(x)
    one = np.uint64(1)
    # from the axes to the transposed index: undo the excess rotations, then the Gray code
    q = one << np.uint64(bits - 1)
    while q > 1:
        low = q - one
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) > 0, q - one, np.uint64(0))
        q >>= one
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def _keys(vectors: np.ndarray, ordering: int) -> np.ndarray:
    """Keys of unit directions: projected, shifted by a part of a cell's span, and cut to a grid."""
    made = np.random.default_rng(1000 + ordering)
    dimensions = min(DIMENSIONS, vectors.shape[1])
    axes = np.linalg.qr(made.normal(size=(vectors.shape[1], dimensions)))[0]
    flat = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ axes
    spread = 3 / np.sqrt(vectors.shape[1])
    shifted = (flat / spread + 1) / 2 * 0.75 + made.uniform(0, 0.25, dimensions)
    cells = 1 << BITS
    return hilbert(np.clip(shifted * cells, 0, cells - 1).astype(np.int64), BITS)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def _nearest(queries: pd.DataFrame, found: pd.DataFrame, most: int, near: np.ndarray | None = None) -> pd.DataFrame:
    """The ``most`` best (query, id, score) of ``found`` for each of ``queries``; ``near`` marks the pairs that count."""
    scores = _stack(queries["vector"]) @ _stack(found["vector"]).T
    if near is not None:
        scores[~near] = -np.inf
    keep = min(most, scores.shape[1])
    best = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
    # all that tie with the last one kept
    lows = np.take_along_axis(scores, best, 1).min(1)
    at, which = np.nonzero((scores >= lows[:, None]) & (scores > -np.inf))
    ids = found["ids"].to_numpy()[which]
    counts = np.array([len(i) for i in ids], np.int64)
    out = pd.DataFrame({
        "q1": np.repeat(queries["k1"].to_numpy()[at], counts), "q2": np.repeat(queries["k2"].to_numpy()[at], counts),
        "vec_id": np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64), "score": np.repeat(scores[at, which], counts),
        "c1": np.repeat(found["k1"].to_numpy()[which], counts), "c2": np.repeat(found["k2"].to_numpy()[which], counts),
    })
    return out.sort_values(["q1", "q2", "score", "vec_id"], ascending=[True, True, False, True]).groupby(["q1", "q2"]).head(most)


NEAREST = "q1 bigint, q2 bigint, vec_id bigint, score double, c1 bigint, c2 bigint"


def _fitted_window(vectors: DataFrame, ranked: DataFrame, most: int) -> int:
    """Smallest window that reaches ``TARGET`` of the true neighbours of a sample of the queries."""
    spark = vectors.sparkSession
    sample = vectors.where("is_query").orderBy(F.xxhash64("k1"), "k1", "k2").select("k1", "k2", "vector").limit(SAMPLE).toPandas()
    if sample.empty:
        return MIN_WINDOW
    shared = spark.sparkContext.broadcast(sample)

    def brute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield _nearest(shared.value, frame, most)

    first = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    true = vectors.select("k1", "k2", "vector", "ids").mapInPandas(brute, NEAREST).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most)
    pairs = true.select("q1", "q2", "c1", "c2").distinct().toPandas()  # at most SAMPLE * most rows
    wanted = pd.concat([pairs[["q1", "q2"]].set_axis(["k1", "k2"], axis=1), pairs[["c1", "c2"]].set_axis(["k1", "k2"], axis=1)]).drop_duplicates()
    places = ranked.join(F.broadcast(spark.createDataFrame(wanted)), ["k1", "k2"]).select("k1", "k2", "ordering", "rank").toPandas()
    own = {(r.k1, r.k2, r.ordering): r.rank for r in places.itertuples()}
    apart = sorted(
        min(abs(own[p.q1, p.q2, o] - own[p.c1, p.c2, o]) for o in range(ORDERINGS)) for p in pairs.itertuples()
    )
    return max(MIN_WINDOW, int(np.ceil(apart[int(np.ceil(TARGET * len(apart))) - 1] * MARGIN)))


def _keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            vectors = _stack(frame["vector"])
            for ordering in range(ORDERINGS):
                yield pd.DataFrame({"ordering": ordering, "key": _keys(vectors, ordering), "k1": frame["k1"], "k2": frame["k2"]})


def _searcher(window: int, most: int):
    def search(key, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(columns=["q1", "q2", "vec_id", "score", "c1", "c2"]).astype({"vec_id": np.int64, "score": float})]
        for at in range(0, len(queries) if len(found) else 0, 256):
            some = queries.iloc[at : at + 256]
            near = np.abs(some["rank"].to_numpy()[:, None] - found["rank"].to_numpy()[None]) <= window
            out.append(_nearest(some, found, most, near))
        return pd.concat([o for o in out if len(o)] or out)[["q1", "q2", "vec_id", "score"]]

    return search


def nearest(
    embeddings: DataFrame, is_query: Column, *, vec_id: str = "vec_id", vector: str = "embedding", most: int = 20, window: int | None = None
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``most`` nearest rows of each query.

    ``is_query`` is a condition on ``vec_id`` (a column of that name). Ties go to the smaller id.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("vector") == lengths.length).select(
        "vec_id", "vector", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"), is_query.alias("is_query")
    )
    # one row per distinct vector, with as many ids as can be among the nearest
    wanted = most + 1
    ids = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = rows.select("k1", "k2", "vec_id").distinct().withColumn("_n", F.row_number().over(ids)).where(F.col("_n") <= wanted)
    listed = few.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    one = rows.groupBy("k1", "k2").agg(F.min("vector").alias("vector"), F.max("is_query").alias("is_query"))
    vectors = cut_lineage(one.join(listed, ["k1", "k2"]))

    keyed = vectors.select("k1", "k2", "vector").mapInPandas(_keyed, "ordering int, key bigint, k1 bigint, k2 bigint")
    numbered = dense_number(keyed, ["ordering", "key", "k1", "k2"], "n")
    size = vectors.count()
    ranked = cut_lineage(numbered.select("k1", "k2", "ordering", (F.col("n") - 1 - F.col("ordering") * size).alias("rank")))
    if window is None:
        window = _fitted_window(vectors, ranked, wanted)

    block = min(max(MIN_BLOCK, window // 8), MAX_BLOCK)
    placed = ranked.join(vectors, ["k1", "k2"])
    lists = placed.select("ordering", F.floor(F.col("rank") / block).alias("block"), "rank", "k1", "k2", "vector", "ids")
    low, high = F.greatest(F.col("rank") - window, F.lit(0)), F.least(F.col("rank") + window, F.lit(size - 1))
    reached = F.sequence(F.floor(low / block), F.floor(high / block))
    asking = placed.where("is_query").select("ordering", F.explode(reached).alias("block"), "rank", "k1", "k2", "vector")
    keys = ["ordering", "block"]
    lists = lists.toDF(*lists.columns)  # columns of its own, as both sides come from one frame
    parts = asking.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInPandas(_searcher(window, wanted), "q1 bigint, q2 bigint, vec_id bigint, score double")
    # rounding may differ between blocks, so a pair is met by its ids alone
    pairs = parts.groupBy("q1", "q2", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    merged = pairs.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= wanted).drop("_n")

    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2")).distinct()
    met = queries.join(merged, ["q1", "q2"]).where("vec_id <> query_id")
    met = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
