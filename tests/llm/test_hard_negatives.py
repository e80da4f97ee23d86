import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabweave.llm import hard_negatives
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, label int, embedding array<double>, score string, anchor int, c1 string"


def brute(rows, positives=5, negatives=5, least=(80, 100), every=100):
    """Over (id, label, vector) rows that take part; repeated rows count once."""
    points = sorted({(i, label, tuple(math.floor(256 * x) for x in v)) for i, label, v in rows})
    out = []
    for at, own, anchor in points:
        if at % every:
            continue
        scored = [(-sum(a * b for a, b in zip(anchor, v, strict=True)), i, label) for i, label, v in points]
        best = sorted((s, i) for s, i, label in scored if label == own and i != at)[:positives]
        for s, i in best:
            fit = sorted((t, j) for t, j, label in scored if label != own and least[0] * -s <= least[1] * -t <= least[1] * -s)[:negatives]
            out += [(at, i, k, j, -s, -t) for k, (t, j) in enumerate(fit, 1)]
    return sorted(out)


def mined(frame, **options):
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % options.pop("every", 100) == 0, **options).collect()))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def made(n, seed, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 7))
    return [(i, int(rng.integers(4)), (centres[i % groups] + 0.2 * rng.normal(size=7)).round(2).tolist()) for i in range(n)]


def test_the_whole_table(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, FOLDER).collect())) == brute(rows)


def test_odd_rows(spark):
    rows = made(300, 1)
    rows += [(1000 + i, i % 3, rows[100][2]) for i in range(150)]  # ties, some of them anchors
    rows += [rows[5], rows[100], (100, 3, rows[7][2]), (100, rows[100][1], rows[8][2]), (2000, 1, [0.0] * 7), (2100, 2, [-x for x in rows[100][2]])]
    odd = [(3000, None, rows[0][2]), (None, 1, rows[0][2]), (3100, 1, None), (3200, 1, [1.0, None, *[0.0] * 5]), (3300, 1, [math.nan] * 7), (3400, 1, [math.inf] * 7), (3500, 1, [1.0]), (3600, 1, [])]
    expected = brute(rows)
    assert len(expected) > 50
    assert mined(table(spark, rows + odd)) == expected


@pytest.mark.parametrize("anchor_bytes, chunk_bytes, batch", [(300, 1 << 20, 3), (1 << 20, 700, 1)])
def test_sizes_change_nothing(spark, monkeypatch, anchor_bytes, chunk_bytes, batch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(hard_negatives, "ROWS_PER_CELL", 4)
    rows = made(400, 2)
    books = [np.random.default_rng(k).normal(size=(5, w)) * 200 for k, w in enumerate((3, 4))]
    assert mined(table(spark, rows), every=25, positives=3, negatives=4, least=(9, 10)) == brute(rows, 3, 4, (9, 10), 25)
    # in chunks and batches of other sizes, run here as a task would
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", batch)
    whole = np.floor(256 * np.array([v for _, _, v in rows]))
    ids, labels = np.arange(len(rows)), np.array([label for _, label, _ in rows])
    codes = [hard_negatives.nearest(h, b) for h, b in zip(hard_negatives._halves(whole), books, strict=True)]
    chunk = hard_negatives.Chunk(books, *codes, ids, labels, whole)
    scores = chunk.vectors @ whole[0]
    (low1, high1), (low2, high2) = chunk.bounds(whole[:1])
    for least, most in [(-math.inf, math.inf), (0, math.inf), (0, 40_000), (50_000, 60_000)]:
        seen = [*hard_negatives.visit(chunk, [low1[0], low2[0]], [high1[0], high2[0]], lambda a=least, b=most: (a, b))]
        seen = np.concatenate([np.zeros(0, int), *seen])
        assert len(np.unique(seen)) == len(seen)
        assert set(np.flatnonzero((scores >= least) & (scores <= most))) <= set(seen)


def test_clustered_cells_are_passed_over():
    """With clear groups most cells are certified away."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 300
    whole = np.floor(centres[np.arange(8000) % 40] + rng.normal(size=(8000, 16)))
    books = [hard_negatives.codebook(h, 40) for h in hard_negatives._halves(whole)]
    codes = [hard_negatives.nearest(h, b) for h, b in zip(hard_negatives._halves(whole), books, strict=True)]
    chunk = hard_negatives.Chunk(books, *codes, np.arange(8000), np.zeros(8000, int), whole)
    best = hard_negatives.Best(5)
    (low1, high1), (low2, high2) = chunk.bounds(whole[:1])
    seen = 0
    for rows in hard_negatives.visit(chunk, [low1[0], low2[0]], [high1[0], high2[0]], lambda: (best.need(), math.inf)):
        best.add(hard_negatives._scores(chunk.vectors[rows], whole[0]), chunk.ids[rows])
        seen += len(rows)
    scores = whole @ whole[0]
    assert best.found == [(-int(scores[i]), int(i)) for i in np.lexsort((np.arange(8000), -scores))[:5]]
    assert seen < 2000


def test_few_or_no_rows(spark):
    rows = [(0, 1, [1.0]), (1, 1, [0.5]), (2, 0, [0.45]), (3, 0, [0.6])]
    assert mined(table(spark, rows)) == brute(rows) == [(0, 1, 1, 2, 128 * 256, 115 * 256)]
    assert mined(table(spark, [])) == [] == mined(table(spark, [(1, 1, [1.0])]))
    assert mined(table(spark, [(0, 1, [-1.0]), (1, 1, [1.0]), (2, 0, [1.0])])) == []  # a negative positive


def test_large_integers(spark):
    big = [(0, 1, [8e6, 7e6]), (1, 1, [8e6, 1.5]), (2, 0, [7.5e6, 3.25])]
    assert mined(table(spark, big)) == brute(big) != []
    assert hard_negatives._scores(np.array([[2.0**30, 3.0]]), np.array([2.0**30, 1.0])).tolist() == [2**60 + 3]
    with pytest.raises(OverflowError):
        hard_negatives._scores(np.full((1, 8), 2.0**31), np.full(8, 2.0**31))
