"""Whitening against a direct computation over the distinct vectors."""

import math
from collections import Counter

import numpy as np
import pytest

from tallyfold.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, y int, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def x_of(v):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def brute(rows, weights="one"):
    kept = [(i, x_of(v)) for i, v in rows if usable(v)]
    width = Counter(len(x) for _, x in kept).most_common(1)[0][0]
    kept = [(i, x) for i, x in kept if len(x) == width]
    counts = Counter(x for _, x in kept)
    distinct = sorted(counts)
    w = np.array([counts[x] if weights == "count" else 1 for x in distinct])
    n = int(w.sum())
    s = [sum(int(c) * x[d] for c, x in zip(w, distinct)) for d in range(width)]
    centred = np.array([[(n * x[d] - s[d]) / n for d in range(width)] for x in distinct])
    cov = (centred * w[:, None]).T @ centred / n
    deviation = {x: sum((n * x[d] - s[d]) ** 2 for d in range(width)) for x in distinct}
    return kept, distinct, centred, cov, n, deviation


def check(spark, rows, weights="one"):
    kept, distinct, centred, cov, n, deviation = brute(rows, weights)
    found = whitening.whiten(table(spark, rows), weights=weights).collect()
    values, axes = np.linalg.eigh(cov)
    order = [i for i in np.argsort(-values) if values[i] > 1e-12 * values.sum()][:16]
    assert Counter((r.vec_id, r.component) for r in found) == Counter(
        (i, j + 1) for i, _ in kept for j in range(len(order))
    )
    place = {x: j for j, x in enumerate(distinct)}
    white = centred @ axes[:, order] / np.sqrt(values[order])
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = np.zeros(len(order))
    for i, x in kept:
        for j in range(len(order)):
            r = by_id[i][j + 1]
            assert r.n == n and r.deviation == deviation[x]
            assert abs(r.explained - values[order[j]] / values.sum()) < 1e-9
            assert r.identity_error < 1e-6
            expected = white[place[x], j]
            if abs(expected) > 0.1:
                signs[j] = signs[j] or np.sign(expected * r.whitened)
            assert abs(r.whitened - signs[j] * expected) < 1e-6 or abs(expected) <= 0.1


def points(n, width, seed=0):
    rng = np.random.default_rng(seed)
    scale = np.linspace(0.2, 3, width)
    return (rng.normal(size=(n, width)) * scale).astype(np.float32).tolist()


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equals_direct_computation(spark, weights):
    own = points(300, 20)
    rows = list(enumerate(own)) + [(1000 + i, own[0]) for i in range(150)]
    rows += [(2000 + i, own[3]) for i in range(5)]
    check(spark, rows, weights)


def test_unusable_and_odd_vectors(spark):
    rows = list(enumerate(points(60, 5)))
    rows += [(100, None), (101, [1.0, None, 0.0, 1.0, 1.0]), (102, [float("nan")] * 5)]
    rows += [(103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    rows += [(None, [0.0] * 5), (106, [0.0] * 5)]
    check(spark, rows)


def test_fewer_directions_than_components(spark):
    check(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])


def test_one_vector_and_none(spark):
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 0.0]), (3, [0.0, 1.0])]
    found = {r.vec_id: r for r in whitening.whiten(table(spark, rows)).collect()}
    assert found[1].deviation is None and found[3].deviation is not None
