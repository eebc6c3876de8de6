"""Jaccard join against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyfold.llm import jaccard
from tallyfold.llm.components import components
from tallyfold.llm.shingles import shingle_set, word_hashes


def plain_set(text, k):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain_components(rows, k, p, q):
    sets = [(i, plain_set(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            both = len(s & t)
            if s and t and q * both >= p * (len(s) + len(t) - both):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def edited(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(400)]


def corpus(seed, groups=12, copies=9):
    rng = random.Random(seed)
    rows, shared = [], rng.choices(VOCABULARY, k=60)
    for _ in range(groups):
        size = rng.choice([1, 2, 3, 5, 8, 12, 20, 40, 90, 200, 500])
        words = rng.choices(VOCABULARY, k=size)
        for _ in range(copies):
            other = edited(rng, words, rng.choice([0, 0.003, 0.01, 0.02, 0.05]))
            if rng.random() < 0.2:
                other = other + shared
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(other)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, p, q", [(3, 90, 100), (5, 8, 10)])
def test_equals_brute_force(spark, k, p, q):
    rows = corpus(k) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "One"), (9004, "oNE"), (None, "one")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string")
    found = jaccard.join(docs.repartition(5), k, p, q).collect()
    assert len(found) == len(rows)
    expected = plain_components(rows, k, p, q)
    texts = dict(rows)
    for row in found:
        assert row.component_id == expected.get(row.doc_id)
        assert row.n_shingles == len(plain_set(texts[row.doc_id], k))


def test_split_clusters_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    rows = corpus(77, groups=2, copies=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.join(docs, 3, 90, 100).collect()}
    assert found == plain_components(rows, 3, 90, 100)


def test_long_near_copies_leave_blocks_empty(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 600)
    rng = random.Random(78)
    rows = []
    for group in range(6):
        words = [f"g{group}w{rng.randrange(5000)}" for _ in range(300)]
        for copy in range(10):
            rows.append((len(rows), " ".join([*words[copy:], f"end{copy}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.join(docs, 3, 90, 100).collect()}
    assert found == plain_components(rows, 3, 90, 100)
    assert len(set(found.values())) == 6


def test_repeated_rows_and_one_each(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z"), (None, "x y z"), (4, None)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, first_id int")
    joined = jaccard.join(docs)
    assert sorted((r.doc_id or 0, r.component_id) for r in joined.collect() if r.component_id) == [
        (1, 1), (1, 1), (2, 1), (3, 3), (4, 4),
    ]
    kept = jaccard.one_each(docs, joined)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(docs).count() == 0


@pytest.mark.parametrize("p, q", [(90, 100), (8, 10)])
def test_similar_sets_share_a_key(p, q):
    rng = np.random.default_rng(1)
    routing = jaccard.Routing(p, q)
    for size in (1, 2, 3, 7, 9, 10, 11, 17, 19, 20, 33, 100, 150, 151, 400, 1500):
        for _ in range(30):
            base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
            room = int(len(base) * (q - p) / p) + 1
            add = np.unique(rng.integers(0, 2**63, rng.integers(0, room + 1)).astype(np.uint64))
            gone = rng.integers(0, room + 1)
            other = np.union1d(base[gone:], add)
            both = len(np.intersect1d(base, other))
            if not len(other) or q * both < p * (len(base) + len(other) - both):
                continue
            common = base[: rng.integers(0, 2) * len(base) // 2]
            assert set(routing.keys(base, common)) & set(routing.keys(other, common))


def test_trees_find_what_all_pairs_find():
    rng = np.random.default_rng(2)
    for trial in range(20):
        sets = []
        for _ in range(6):
            base = rng.integers(0, 2**63, rng.integers(5, 200)).astype(np.uint64)
            for _ in range(12):
                keep = rng.random(len(base)) > rng.choice([0.02, 0.08, 0.2])
                sets.append(np.unique(base[keep]) if keep.any() else np.unique(base))
        sides = rng.integers(0, 2, len(sets)) if trial % 2 else np.zeros(len(sets), int)
        links = jaccard.linked(sets, sides, 8, 10)

        def labels(pairs):
            label = list(range(len(sets)))
            for x, y in pairs:
                a, b = sorted((label[x], label[y]))
                label = [a if v == b else v for v in label]
            return label

        every = []
        for x in range(len(sets)):
            for y in range(x + 1, len(sets)):
                both = len(np.intersect1d(sets[x], sets[y]))
                if trial % 2 and sides[x] == sides[y]:
                    continue
                if 10 * both >= 8 * (len(sets[x]) + len(sets[y]) - both):
                    every.append((x, y))
        assert labels(links) == labels(every)


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    from tallyfold.llm import shingles

    text = " ".join(f"Wörd{i % 97}" for i in range(3000))
    whole = word_hashes(text)
    monkeypatch.setattr(shingles, "CHUNK", 50)
    assert (word_hashes(text) == whole).all()
    assert len(np.unique(whole)) == 97 and len(shingle_set(text, 3)) == 97


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in touched}


def test_unrelated_documents_form_no_clusters(spark, monkeypatch):
    rng, rows, placed = random.Random(5), [], []
    passages = [[f"p{i}x{j}" for j in range(50)] for i in range(20)]
    for i in range(300):  # short sets of which no two are alike
        rows.append((i, " ".join(f"s{rng.randrange(10**6)}" for _ in range(rng.randrange(6, 40)))))
    for i in range(300, 400):  # long ones with passages in common, the last two near copies
        parts = [[f"l{rng.randrange(10**6)}" for _ in range(400)], *rng.sample(passages, 4)]
        rows.append((i, " ".join(sum(parts, [])) if i < 399 else rows[-1][1] + " more"))
    inner = jaccard.written

    def written(df, label, **options):
        made = inner(df, label, **options)
        if label == "clustered":
            placed.extend(made.collect())
        return made

    monkeypatch.setattr(jaccard, "written", written)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}
    assert found == {i: min(i, 398) for i in range(400)}
    assert sum(r.blocks for r in placed) < 20  # copies of sets that are sent to be compared


@pytest.mark.parametrize("p, q", [(90, 100), (8, 10)])
def test_similar_sets_share_enough_keys(p, q):
    rng = np.random.default_rng(4)
    routing, pairs = jaccard.Routing(p, q), 0
    for size in (1, 2, 5, 9, 12, 19, 20, 40, 100, 151, 400, 1500):
        for _ in range(40):
            base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
            room = int(len(base) * (q - p) / p) + 1
            other = np.union1d(base[rng.integers(0, room + 1) :], rng.integers(0, 2**63, rng.integers(0, room + 1)).astype(np.uint64))
            both = len(np.intersect1d(base, other))
            if not len(other) or q * both < p * (len(base) + len(other) - both):
                continue
            common = base[rng.random(len(base)) < rng.choice([0, 0.3, 0.9, 1])]
            often = rng.integers(64, 99, len(common))
            shared = np.intersect1d(routing.keys(base, common, often), routing.keys(other, common, often))
            code, n = np.unique(shared.view(np.uint64) & jaccard.CODE, return_counts=True)
            assert routing.enough(code.astype(int), n, np.full(len(n), len(base)), np.full(len(n), len(other))).any()
            pairs += 1
    assert pairs > 100


@pytest.mark.parametrize("paired, sorted_rows", [(64, 200_000), (3, 7), (3, 200_000), (64, 7)])
def test_shared_keys_are_counted(monkeypatch, paired, sorted_rows):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "SORTED_ROWS", sorted_rows)
    rng = np.random.default_rng(6)
    rows = sorted((int(k) * 128 + int(k) % 3, int(n)) for k, n in zip(rng.integers(-9, 30, 400), rng.integers(0, 40, 400) ** 2 // 40))
    batch = lambda part: pa.RecordBatch.from_pylist([{"key": k, "node": n} for k, n in part], pa.schema([("key", pa.int64()), ("node", pa.int64())]))
    found = Counter()
    for out in jaccard.shared_keys(batch(rows[at : at + 5]) for at in range(0, 400, 5)):
        for a, b, code, n in zip(out["a"], out["b"], out["code"], out["n"]):
            found[int(a), int(b), int(code)] += 1 if code < 0 else int(n)
    expected, stars = Counter(), set()
    for key in {k for k, _ in rows}:
        nodes = sorted({n for k, n in rows if k == key})
        if len(nodes) > paired:
            stars |= {(nodes[0], n, -1) for n in nodes[1:]}
        else:
            expected.update((a, b, key % 128) for x, a in enumerate(nodes) for b in nodes[x + 1 :])
    assert {k for k in found if k[2] < 0} == stars
    assert {k: n for k, n in found.items() if k[2] >= 0} == dict(expected)
    assert list(jaccard.shared_keys([batch([])])) == []
