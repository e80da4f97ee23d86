import math

import numpy as np
from pyspark.sql import functions as F

from vocabweave.llm import neighbours
from vocabweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def brute(rows, most=20):
    """{query: [(id, score)]} over usable (id, vector) rows."""
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float64)
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[at]
        order = [i for i in np.lexsort((ids, -scores.round(12))) if ids[i] != ids[at]][:most]
        out[int(ids[at])] = [(int(ids[i]), scores[i]) for i in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    expected, found = brute(rows), by_query(QUERIES["op3_nearest_neighbours"](spark, FOLDER))
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in own}) for q, own in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, own in found.items():
        assert all(math.isclose(s, vectors[q] @ vectors[i], rel_tol=1e-12) for i, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and len(own) == 20


def test_odd_rows(spark):
    made = np.random.default_rng(1).normal(size=(150, 6)).tolist()
    rows = [(i, v) for i, v in enumerate(made)]
    rows += [(200 + i, made[7]) for i in range(60)]  # copies, three of them queries
    odd = [(1000, None), (1020, [0.0] * 6), (1040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1060, [math.nan] + [1.0] * 5), (1080, [math.inf] * 6), (None, made[0]), (1100, [1.0]), (1120, [])]
    frame = spark.createDataFrame([*rows, *odd, rows[3], rows[40]], "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1))
    found = by_query(neighbours.nearest(frame, F.col("vec_id") % 20 == 0))
    expected = brute(rows)
    assert found.keys() == expected.keys()
    for q, own in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in own]


def test_few_or_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert by_query(neighbours.nearest(frame, F.col("vec_id") % 20 == 0)) == {0: [(2, 2.0), (1, 0.5)]}
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_steps_to_neighbouring_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()
