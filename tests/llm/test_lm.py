"""LM scores: counts against plain Python, gradients, and windows against one by one."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyfold.llm import lm
from tallyfold.llm.queries import vocabulary_path


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def corpus():
    rng = random.Random(1)
    names = ["The", "of", "river", "stone", "moved", "é", "日本", "a b"]
    rows = [(i, " ".join(rng.choice(names) + rng.choice(["", "s", "ing", str(rng.randrange(50))]) for _ in range(rng.randint(0, 150)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "Word\x0bWord\n" * 3000), (None, "of of"), (3, rows[3][1])]


@pytest.mark.parametrize("top", [200_000, 4])
def test_base_scores(spark, monkeypatch, top):
    monkeypatch.setattr(lm, "ROUNDS", 1)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 0.0, 1) for r in rows], "doc_id long, text string, score double, n int")
    found = lm.score(docs.repartition(4), vocabulary_path(), share=0.5, least_texts=20, top_words=top).collect()
    assert len(found) == len(rows)
    counts = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(tokens(t))
    total, kinds, texts = sum(counts.values()), len(counts), dict(rows)
    for r in found:
        own = tokens(texts[r.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    same = [r.score for r in found if r.doc_id == 3]
    assert math.isclose(same[0], same[1], rel_tol=1e-5)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(docs, vocabulary_path()).count() == 0


def model_and_codes(size=600):
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, size).astype(float)
    windows = rng.integers(0, size, (50, lm.WINDOW + 1))
    model = lm.Attention(1)
    model.parts["bias"] = rng.normal(size=lm.GROUPS).astype(np.float32)
    table = np.zeros((size, lm.CONTEXTS))
    np.add.at(table, (windows[:, 1:], lm.contexts(counts)[windows[:, :-1]]), 1)
    return lm.coded(counts, table), model, rng


def test_classes_share_all_probability():
    codes, model, rng = model_and_codes()
    hidden = rng.normal(size=(1, lm.WIDTH)).astype(np.float32)
    total = sum(
        math.exp(float(model.class_logs(hidden, np.array([c]))[0])) * np.exp(codes.share[codes.classes == c]).sum()
        for c in range(lm.CLASSES)
        if (codes.classes == c).any()
    )
    unused = sum(math.exp(float(model.class_logs(hidden, np.array([c]))[0])) for c in range(lm.CLASSES) if not (codes.classes == c).any())
    assert math.isclose(total + unused, 1, rel_tol=1e-4)


def test_windows_score_each_id_once():
    codes, model, rng = model_and_codes()
    end = 599
    scorer = lm.Scorer(codes, model, end)
    texts = [np.append(rng.integers(0, 599, n), end) for n in (0, 1, 47, 62, 63, 64, 65, 111, 112, 113, 500)]
    found = scorer.scores(texts)
    for ids, score in zip(texts, found):
        total, back = 0.0, np.concatenate([[end], ids[:-1]])
        for i in range(len(ids)):
            start = 0 if i < lm.WINDOW else (i - (lm.WINDOW - lm.STRIDE)) // lm.STRIDE * lm.STRIDE
            hidden, _ = model.hidden(codes.inputs[back[start : i + 1]][None])
            total += float(model.class_logs(hidden[0, -1:], codes.classes[ids[i : i + 1]])[0]) + codes.share[ids[i]]
        assert math.isclose(score, total / math.log(10), rel_tol=1e-4)


def test_gradients_are_those_of_the_loss():
    _, model, rng = model_and_codes()
    for name in model.parts:
        model.parts[name] = model.parts[name].astype(np.float64)
    rows, classes = rng.integers(0, lm.INPUTS, (3, lm.WINDOW)), rng.integers(0, lm.CLASSES, (3, lm.WINDOW))
    real = np.arange(lm.WINDOW) < np.array([[lm.WINDOW], [5], [1]])
    _, down = model.gradients(rows, classes, real)
    for name, weights in model.parts.items():
        at = np.unravel_index(np.abs(down[name]).argmax(), weights.shape)
        weights[at] += 1e-4
        high, _ = model.gradients(rows, classes, real)
        weights[at] -= 2e-4
        low, _ = model.gradients(rows, classes, real)
        weights[at] += 1e-4
        assert math.isclose((high - low) / 2e-4, down[name][at], rel_tol=2e-2), name


def test_training_learns():
    codes, model, rng = model_and_codes()
    rows = np.tile(rng.integers(0, 30, 16), (200, 5))[:, : lm.WINDOW + 1]
    batch = rows[:, :-1], rows[:, 1:], np.ones((200, lm.WINDOW))
    losses = [model.learn([batch] * 30, lambda n: 0)[0] for _ in range(3)]
    assert losses[-1] < 0.5 * losses[0]


def test_windows_cover_whole_texts(spark):
    """Every id of a chosen text is a target once, short texts and last windows included."""
    coder = lm.subwords(vocabulary_path())
    texts = ["", "a", "river stone " * 200, *(f"w{i} " * i for i in range(1, 80))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm.training_windows(docs.repartition(3), len(texts), vocabulary_path(), 1.0, 0).collect()
    found, wanted = Counter(), Counter()
    for r in rows:
        assert len(r.ids) == lm.WINDOW + 1 and 0 < r.real <= lm.WINDOW
        found.update(zip(r.ids[: r.real], r.ids[1 : r.real + 1]))
    for text in texts:
        ids = [coder.end, *coder.ids(lm.text_words(text)).tolist()]
        wanted.update(zip(ids, ids[1:]))
    assert found == wanted
    half = lm.training_windows(docs, len(texts), vocabulary_path(), 0.5, 0).count()
    assert 0 < half < len(rows)


def test_neighbours_of_ids_outside_the_windows(spark):
    coder = lm.subwords(vocabulary_path())
    ids = coder.ids([b"unbelievableness"])
    docs = spark.createDataFrame([(1, "of of")], "doc_id long, text string")
    words = spark.createDataFrame([("of", 2), ("unbelievableness", 7)], "word string, n long")
    counts = lm.subword_counts(words, vocabulary_path(), coder.end + 1)
    windows = lm.training_windows(docs, 1, vocabulary_path(), 1.0, 0)
    found = lm.neighbour_counts(windows, words, counts, vocabulary_path())
    context = lm.contexts(counts)
    assert len(ids) > 2
    for before, after in zip(ids[:-2], ids[1:-1]):
        assert found[after, context[before]] >= 7
    assert found[ids[0]].sum() == 0


def test_tasks_train_one_model(spark, monkeypatch):
    """The averaged model of many shards beats the base counts of its own classes."""
    monkeypatch.setattr(lm, "SHARD_WINDOWS", 200)
    rng = random.Random(3)
    lines = ["the river moved the stone", "a green hill across the water", "stones of the old river"]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.score(docs.repartition(4), vocabulary_path()).filter("held_out").collect()
    assert len(found) > 30
    assert np.mean([r.score - r.base_score for r in found]) > 20


def test_all_training_texts_are_trained_on(spark, monkeypatch):
    """Without a share asked for, every id of every training text is a target."""
    seen = {}

    def trained(windows, codes, count, rounds):
        seen["ids"] = sum(r.real for r in windows.select("real").collect())
        return lm.Attention(0)

    monkeypatch.setattr(lm, "trained", trained)
    texts = [f"w{i % 7} of" for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lm.score(docs.repartition(4), vocabulary_path()).count()
    coder = lm.subwords(vocabulary_path())
    learned = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    assert len(learned) > 2500
    assert seen["ids"] == sum(len(coder.ids(lm.text_words(t))) for t in learned)


@pytest.mark.parametrize("count", [1, 1000, 30_000, 50_000, 79_999, 80_000, 200_000, 10**9])
def test_rounds_go_over_every_window(count):
    """All slots equally often, once at least; as often as before where windows are few."""
    plan = lm.schedule(count, 4)
    times = Counter(slot for slots, passes in plan for slot in slots for _ in range(passes))
    assert len(plan) == 4 and sorted(times) == [0, 1, 2, 3] and len(set(times.values())) == 1
    if count <= lm.LEAST_WINDOWS:
        assert plan[0][1] == min(lm.MOST_PASSES, lm.LEAST_WINDOWS // count)


def test_target_counts_are_those_of_the_words(spark):
    coder = lm.subwords(vocabulary_path())
    docs = spark.createDataFrame([(1, "of of unbelievableness"), (2, None), (3, "of " * 100)], "doc_id long, text string")
    windows = lm.training_windows(docs, 3, vocabulary_path(), 1.0, 0)
    wanted = lm.subword_counts(lm.word_counts(docs), vocabulary_path(), coder.end + 1)
    wanted[coder.end] += 3
    assert (lm.target_counts(windows, coder.end + 1) == wanted).all()


def test_texts_are_coded_once(spark):
    """Training and scoring go on from the ids that one pass stored, not from the texts."""
    rows = [(1, "of of unbelievableness"), (2, ""), (3, "river stone " * 200), (4, "Of OF"), (None, "é x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    top = spark.sparkContext.broadcast({b"of": 1.5})
    coded = lm.coded_texts(docs.coalesce(1), vocabulary_path(), top, 0.25, 1)
    coder, found = lm.subwords(vocabulary_path()), coded.collect()
    firsts = {r.doc_id: r for r in found if r.kind == 0}
    for doc, text in rows:
        words, own = lm.text_words(text), firsts[doc]
        assert np.frombuffer(own.ids, coder.kind).tolist() == coder.ids(words).tolist()
        assert (own.n, own.known) == (len(words) + 1, words.count(b"of") + 1)
        assert math.isclose(own.log, 1.5 * words.count(b"of") + 0.25)
        rest = {r.word: r.n for r in found if r.kind == 1 and r.row == own.row}
        assert rest == Counter(w.decode() for w in words if w != b"of")
    again = lm.training_windows(coded.filter("kind = 0"), len(rows), vocabulary_path(), 1.0, 0)
    wanted = lm.training_windows(docs.coalesce(1), len(rows), vocabulary_path(), 1.0, 0)
    assert again.collect() == wanted.collect()
