"""Graph search against brute force."""

import numpy as np

from tallyfold.llm import hnsw


def table(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")


def brute(rows, query_id, vector, k):
    found = sorted(
        {
            (float(np.sqrt(((np.float64(v) - np.float64(vector)) ** 2).sum())), i)
            for i, v in rows
            if i != query_id and len(v) == len(vector)
        }
    )
    return found[:k]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    points = (centres[rng.integers(0, 30, 1500)] + 0.4 * rng.normal(size=(1500, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    found = {}
    for r in hnsw.nearest(table(spark, rows), "vec_id % 20 = 0", k=10, shard_rows=400).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert len(found) == 75
    hits = 0
    for query, own in found.items():
        own.sort()
        expected = brute(rows, query, rows[query][1], 10)
        assert [x[0] for x in own] == list(range(1, 11))
        for _, score, vec in own:
            exact = np.sqrt(((np.float64(points[vec]) - np.float64(points[query])) ** 2).sum())
            assert abs(score - exact) < 1e-9
        hits += len({x[2] for x in own} & {i for _, i in expected})
    assert hits / 750 >= 0.95


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 200)] + [(300 + i, [1.0, 2.0 + i]) for i in range(1, 6)]
    rows += [(0, [1.0, 2.0]), (400, [3.0]), (500, [4.0, 4.0, 4.0])]
    odd = [(600, None), (700, [0.0, 0.0]), (800, [nan, 1.0]), (900, [inf, 1.0]), (1000, [None, 1.0]), (None, [1.0, 2.0])]
    found = {}
    for r in hnsw.nearest(table(spark, rows + odd), "vec_id % 100 = 0", k=10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {0, 100}
    for query in (0, 100):
        expected = [i for i in range(12) if i != query][:10]
        assert [v for _, v, _ in sorted(found[query])] == expected
        assert all(s == 0 for *_, s in found[query])


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    found = sorted((r["rank"], r.vec_id) for r in hnsw.nearest(table(spark, rows), "vec_id = 0").collect())
    assert found == [(1, 1), (2, 2)] or found == [(1, 2), (2, 1)]
    assert found == [(1, 2), (2, 1)]


def test_empty_table(spark):
    assert hnsw.nearest(table(spark, [(1, [1.0])]).limit(0), "vec_id = 0").count() == 0
