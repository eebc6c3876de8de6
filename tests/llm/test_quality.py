"""Bradley-Terry classifier: gradients rank pairs, held-out documents are told apart."""

import random
import zlib

import numpy as np

from tallyfold.llm import quality


def corpus():
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(500):
        words = [rng.choice(["the", "of", "stone", "river", "moved", "across", "green"]) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(3, 200))]
        bad = rng.random() < 0.3
        if bad:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w + "***" for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad)))
    return rows, marks


def test_held_out_documents(spark):
    rows, marks = corpus()
    extra = [(900, None), (901, ""), (902, "x" * 200_000), (None, "the river"), (3, rows[3][1])]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows + extra], "doc_id long, text string, score double, quality int")
    labels = spark.createDataFrame([*marks, (None, 1), (4, None), (5, dict(marks)[5])], "doc_id long, quality int")
    found = quality.classify(docs.repartition(3), labels).collect()
    assert len(found) == len(rows) + len(extra)
    held = [r for r in found if r.held_out and r.doc_id in dict(marks)]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held) and len(held) > 60
    assert np.mean([r.predicted == dict(marks)[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert len({r.score for r in found if r.doc_id == 3}) == 1
    assert len({r.score for r in found if r.doc_id in (900, 901)}) == 1


def test_held_out_labels_change_nothing(spark):
    rows, marks = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in marks]
    one, two = (quality.fitted(docs, spark.createDataFrame(m, "doc_id long, quality int")) for m in (marks, turned))
    assert np.array_equal(one.weights, two.weights) and one.cutoff == two.cutoff


def test_weights_are_near_the_least_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, quality.FEATURES))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=600) > 0).astype(float)
    model = quality.ranked(x, y)
    z = np.clip((x - model.mean) / model.spread, -8, 8)
    gap = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])

    def loss(w):
        return np.log1p(np.exp(-np.clip(gap @ w, -50, 50))).mean() + 0.5e-4 * w @ w

    best = loss(model.weights)
    assert all(loss(model.weights + 0.2 * rng.normal(size=len(model.weights))) > best - 0.003 for _ in range(20))
    assert model.weights[0] > model.weights[1] > np.abs(model.weights[2:]).max()


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(round(r.score, 9), r.predicted) for r in quality.classify(docs, none).collect()] == [(0.3, 1)] * 2
    assert quality.classify(docs.limit(0), none).count() == 0
