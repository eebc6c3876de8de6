"""Removal of repeated strings, and suffix sorting, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyfold.llm import repeats, suffixes

SCHEMA = "doc_id long, text string, bytes int, t1 int, found int, id int"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    found = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if t else 0
        sha = hashlib.sha256(kept).hexdigest()
        found.append((i, len(t), len(t) - len(kept), spans, sha))
    return sorted(found, key=str)


def check(spark, rows, length):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    found = repeats.strip(docs, length=length)
    rows_found = found.select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()
    assert sorted((tuple(r)[:-1] for r in rows_found), key=str) == brute(rows, length)
    for r in rows_found:
        assert (r.kept is None) == (r.n_removed == 0)
        assert r.kept is None or hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def words(rng, n, some="abcdefgh"):
    return " ".join("".join(rng.choices(some, k=rng.randint(2, 6))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    common = words(rng, 20)
    rows = []
    for i in range(60):
        text = words(rng, 60, "abcdefghijklmnopqrstuvwxyzäöü")
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text = text[:at] + common + text[at:]
        if i % 7 == 0 and i:
            other = rows[rng.randint(0, i - 1)][1]
            text += other[rng.randint(0, 50) : rng.randint(100, 300)]
        rows.append((i, text))
    edited = list(rows[5][1])
    edited[len(edited) // 2] = "#"
    return [*rows, (100, "".join(edited)), (101, rows[6][1]), (102, rows[7][1] * 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    check(spark, corpus(seed), 40)


def test_nulls_short_periodic_and_repeated_rows(spark):
    rng = random.Random(3)
    text = words(rng, 80)
    rows = [(1, None), (2, ""), (3, ""), (4, "short"), (None, text), (None, text), (5, text)]
    rows += [(6, "a" * 500), (7, "ab" * 300), (8, "x" * 39), (9, "y" * 40), (10, "z" * 41)]
    rows += [(11, words(rng, 10) + "abc" * 40 + words(rng, 10)), (12, "é" * 100), (12, "é" * 100)]
    check(spark, rows, 40)


def test_empty_table(spark):
    assert repeats.strip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_anchors_with_many_passages_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_PASSAGES", 3)
    monkeypatch.setattr(repeats, "CHUNK", 300)
    monkeypatch.setattr(repeats, "ARRAY_BYTES", 500)
    check(spark, corpus(4), 40)


def test_length_of_the_contract(spark):
    rng = random.Random(5)
    shared = words(rng, 150)
    rows = [(i, words(rng, 150) + shared[: 380 + 7 * i] + words(rng, 90)) for i in range(12)]
    check(spark, rows, repeats.LENGTH)


@pytest.mark.parametrize("letters", ["a", "ab", "abcd", "abcdefghijkl\0\1"])
def test_suffix_order(letters):
    rng = random.Random(len(letters))
    passages = ["".join(rng.choices(letters, k=rng.randint(12, 60))).encode() for _ in range(30)]
    data = b"".join(passages)
    text = np.frombuffer(data, np.uint8)
    sizes = np.array([len(p) for p in passages])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    heads = sizes - 11
    order = suffixes.suffix_order(data, text, suffixes._words(text), starts, ends, heads, 12)
    end = np.repeat(ends, sizes)
    suffix = [data[i : min(i + 12, end[i])] for i in order]
    assert suffix == sorted(suffix)
    wanted = {s + i for s, h in zip(starts.tolist(), heads.tolist()) for i in range(h)}
    assert wanted <= set(order.tolist()) and len(set(order.tolist())) == len(order)
    counts = Counter(p[i : i + 12] for p in passages for i in range(len(p) - 11))
    for p, hit in zip(passages, suffixes.repeated_heads(passages, 12)):
        assert hit.tolist() == [i for i in range(len(p) - 11) if counts[p[i : i + 12]] > 1]
