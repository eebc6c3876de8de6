"""The Merkle manifest against a plain recursive construction."""

import hashlib
import zlib

import pytest

from tallyfold.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx int, key string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    text = None if value is None else str(value)
    return "-" if text is None else f"{len(text.encode())}:{text}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(levels, place):
    """Siblings per level of the leaf at ``place``."""
    found = []
    for level in levels[:-1]:
        run = level[place // 16 * 16 : place // 16 * 16 + 16]
        found.append((run[: place % 16], run[place % 16 + 1 :]))
        place //= 16
    return found


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def brute(rows):
    def leaf(r, text):
        return h(*map(field, (r[0], r[3], r[2], r[4], text)))

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0], leaf(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    found = []
    for j, s in enumerate(order):
        for i, (doc_id, own, r) in enumerate(groups[s]):
            path = climb(trees[s], i) + climb(top, j)
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            now = leaf(r, lowered(r[1]) if hit else r[1])
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*[x for left, right in path for x in left + right])
            root = top[-1][0]
            found.append((doc_id, own, trees[s][-1][0], root, proof, now, now == root))
    return sorted(found, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = queries.verified_leaves(docs)
    assert found.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def rows_of(n, source, first=0):
    return [(first + i, f"Text Ä {i}" if i % 3 else f"low {i}", "en", source, i) for i in range(n)]


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [300, 1, 16, 5], [1] * 20, [4100, 3]])
def test_trees_of_all_shapes(spark, sizes):
    rows = [r for j, n in enumerate(sizes) for r in rows_of(n, f"s{j}", 10_000 * j)]
    check(spark, rows)


def test_nulls_repeats_and_long_texts(spark):
    rows = rows_of(40, "é") + rows_of(3, None, 100) + rows_of(2, "", 200) + rows_of(2, "Z", 300)
    rows += [(None, None, None, None, None), (None, "A" * 300_000, None, "é", None)]
    rows += [(7, "Same", "en", "é", 4)] * 40 + [(7, "Other", "en", "é", 4), (1, "", "", "é", 0)]
    check(spark, rows)


def test_empty_table(spark):
    assert queries.verified_leaves(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_of_high_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_COPY", 3)
    check(spark, rows_of(1500, "a") + rows_of(40, "b", 5000))


def test_tampered_leaves_fail(spark):
    rows = [(i, "ABC", "en", "s", 3) for i in range(200)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    for r in queries.verified_leaves(docs).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0)
