"""Kneser-Ney models: probabilities add up, and held-out texts are recognised."""

import random

import numpy as np

from tallyfold.llm import language

SOUNDS = {"aa": ["ba", "ko", "mi", "ra", "tu"], "bb": ["sch", "ung", "er", "pf", "el"], "cc": ["é", "ou", "que", "tion"]}


def text(rng, lang, words=60):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(spark, count=400):
    rng = random.Random(1)
    rows = [(i, text(rng, lang), lang) for i in range(count) for lang in [rng.choice(sorted(SOUNDS))]]
    rows += [
        (5000, None, "aa"), (5001, "", "aa"), (5002, "12 34 !", "aa"), (5003, text(rng, "bb"), None),
        (None, text(rng, "cc"), "cc"), (5004, "ßßß" * 60_000, None), (5005, "漢字" * 400, None),
        (1, rows[1][1], rows[1][2]),
    ]
    return rows, spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, lang string, score double, rejected boolean")


def test_probabilities_add_up_to_one():
    rng = random.Random(2)
    counts = {k: language.gram_counts([text(rng, k, 400)], 4) for k in ("aa", "bb")}
    model = language.Model(counts)
    letters = sorted({g for c in counts.values() for g in c if len(g) == 1})
    for prefix in ("", "b", "ba", "bako", "er", "sch", "zz"):
        words = [prefix + c for c in letters if c != " "]
        base = model.word_scores([prefix])[0, :-1] if prefix else None
        total = np.zeros(2)
        for word in words:
            total += np.exp(model.word_scores([word])[0, :-1] - _after(model, word))
        if prefix:
            total += np.exp(base)
            start = np.exp(_after(model, prefix + "?") if False else _prefix(model, prefix))
            assert np.allclose(total / start, 1 - model_unknown(model, prefix), atol=2e-3)


def _prefix(model, prefix):
    """Log-probability of the letters of a prefix, without the end."""
    return model.word_scores([prefix])[0, :-1] - _end(model, prefix)


def _end(model, word):
    padded = f" {word} "
    found = np.zeros(len(model.langs))
    for i in range(len(model.langs)):
        found[i] = _one(model, padded[:-1], " ", i)
    return found


def _after(model, word):
    return _end(model, word)


def _one(model, context, letter, column):
    """Log-probability of a letter, straight from the tables."""
    weight = 0.0
    for size in range(min(model.order, len(context) + 1), 0, -1):
        gram = (context + letter)[-size:]
        points = np.array([ord(c) for c in gram], np.uint32)
        value = model._find(model.grams[size - 1], language.gram_hashes(points, size))[0, column]
        if not np.isnan(value):
            return weight + value
        if size > 1:
            back = model._find(model.contexts[size - 1], language.gram_hashes(points[:-1], size - 1))[0, column]
            weight += 0 if np.isnan(back) else back
    return weight + model.floor + np.nan_to_num(model.contexts[0][1][0, column])


def model_unknown(model, prefix):
    """What is left for letters that no language knows."""
    return np.exp([_one(model, f" {prefix}", "\U0010ffff", i) for i in range(len(model.langs))])


def test_held_out_languages(spark):
    rows, docs = corpus(spark)
    found = {}
    for r in language.identify(docs.repartition(4)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    right = [found[i][0].lang_pred == lang for i, t, lang in rows if i is not None and i < 5000]
    assert np.mean(right) > 0.99
    assert not any(found[i][0].rejected for i in range(400))
    for i in (5000, 5001, 5002):
        assert found[i][0].lang_pred == "und" and found[i][0].score == 0 and found[i][0].rejected
    assert found[5003][0].lang_pred == "bb" and found[None][0].lang_pred == "cc"
    assert found[5005][0].rejected and found[5004][0].lang_pred != "und"
    assert len({tuple(r) for r in found[1]}) == 1
    assert all(0 <= r.score <= 1 for own in found.values() for r in own)


def test_cache_limit_changes_nothing(monkeypatch):
    rng = random.Random(3)
    model = language.Model({k: language.gram_counts([text(rng, k, 300)], 4) for k in SOUNDS})
    texts = [text(rng, k, 50) + " " + "ba" * 40 for k in SOUNDS for _ in range(5)]
    whole = language.Scorer(model).sums(texts)
    monkeypatch.setattr(language, "CACHED", 20)
    scorer = language.Scorer(model)
    assert np.allclose(np.vstack([scorer.sums([t]) for t in texts]), whole, rtol=1e-5)


def test_junk_does_not_raise_the_limit(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, lang), lang) for i in range(600) for lang in [rng.choice(["aa", "bb"])]]
    junk = [(i, "ba ko " + " ".join("xqz"[rng.randrange(3)] * 9 for _ in range(30)), "aa") for i in range(600, 616)]
    near = [*(SOUNDS["aa"] * 6), "bu", "ka"]  # an unlearned language near a learned one
    other = [
        (i, " ".join("".join(rng.choice(near) for _ in range(3)) for _ in range(60)), None) for i in range(700, 740)
    ]
    docs = spark.createDataFrame(rows + junk + other, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(found[i].rejected for i in range(700, 740))
    assert sum(found[i].rejected for i in range(600)) <= 1


def test_few_documents_take_the_pooled_limit():
    rng = random.Random(5)
    model = language.Model({k: language.gram_counts([text(rng, k, 300)], 4) for k in SOUNDS})
    names, own = ["aa"] * 200 + ["bb"] * 2, np.append(1 + 0.05 * np.random.default_rng(5).random(200), [2, 2.01])
    language.calibrate(model, names, own, np.full(202, 400))
    assert np.isfinite(model.limits).all() and 0 < model.limits.min() and model.limits.max() < 0.5
    usual = model.usual[0]
    language.calibrate(model, names + ["aa"], np.append(own, 9.0), np.full(203, 400))
    assert abs(model.usual[0] - usual) < 0.01 and model.limits.max() < 0.5


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "ba ko", None)], "doc_id long, text string, lang string")
    row = language.identify(docs).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert language.identify(docs.limit(0)).count() == 0
