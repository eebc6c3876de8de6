"""Quality rules against plain Python."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tallyfold.llm import rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def texts():
    rng = random.Random(4)
    made = [
        " ".join(rng.choice(["a", "b", "c", "dé", "#", "x|y", "\n", "\n\n", "\x0b", "\x85", "😀"]) for _ in range(n))
        for n in (0, 1, 2, 3, 4, 5, 10, 49, 50, 51, 120, 400) for _ in range(4)
    ]
    return [None, "", " \n", "one two three one two three", "a\na\n\na", *made, "w " * 30_000]


def test_features_equal_plain_python(spark):
    rows = [(i, t, 3, "w") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, t string")
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    found = rules.judge(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain(rows[r.doc_id][1])
        assert r.kept == (not r.base_failed)  # too few labels: nothing is certified


def test_binomial_bound_is_exact(spark):
    cases = [(n, k, p) for p in (0.02, 0.3) for n in (1, 5, 40, 300, 5000) for k in (0, 1, 3, 20, 90) if k <= n]
    for p in (0.02, 0.3):
        own = [(n, k) for n, k, q in cases if q == p]
        frame = spark.createDataFrame(own, "n long, k long")
        for r in frame.withColumn("at_most", rules.binomial_at_most(F.col("k"), F.col("n"), p)).collect():
            logs = [
                math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1)
                + i * math.log(p) + (r.n - i) * math.log1p(-p)
                for i in range(r.k + 1)
            ]
            exact = sum(map(math.exp, logs)) if r.k < r.n * p else 1.0
            assert math.isclose(r.at_most, exact, rel_tol=1e-9)


def test_cutoffs_reject_junk_and_keep_the_limit(spark):
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(900):
        words = [rng.choice("abcdefghij") * rng.randint(1, 9) + str(rng.randrange(999)) for _ in range(60)]
        bad = i % 3 == 0
        rows.append((i, " ".join(w + "***" if bad else w for w in words)))
        marks += [(i, 0 if bad else 1)] * (1 + (i % 7 == 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = {r.doc_id: r for r in rules.judge(docs, labels).collect()}
    assert all(found[i].kept == (i % 3 != 0) for i in found)
    good = rules.features(docs).filter("doc_id % 3 <> 0")
    (row,) = rules.certified_cutoffs(good).collect()
    assert row.n == 600 and row.k <= 0.02 * row.n


def test_repeated_rows_are_no_evidence(spark):
    """Thirty good documents certify nothing, however often they or their texts repeat."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(30)]
    wild = [(100 + i, " ".join(f"v{i}x{j}###" for j in range(60))) for i in range(20)]
    again = rows * 20 + [(1000 + n, rows[n % 30][1]) for n in range(600)] + wild
    docs = spark.createDataFrame(again, "doc_id long, text string")
    good = [(i, 1) for i, _ in again if not 100 <= i < 120]
    labels = spark.createDataFrame(good, "doc_id long, quality int")
    assert all(r.kept for r in rules.judge(docs, labels).collect())
    twice = spark.createDataFrame([*rows, (0, rows[1][1] + " end")], "doc_id long, text string")
    assert rules.distinct_documents(rules.features(twice)).count() == 30


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
