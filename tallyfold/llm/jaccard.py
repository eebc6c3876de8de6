"""N-gram Jaccard join with signature trees.

Documents become sets of hashed word shingles. Equal sets are one node. Every pair of sets that
may reach the similarity meets under a routing key (``Routing``); chains of shared keys form
clusters, and inside a cluster signature trees find all links exactly.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import map_batches
from tallyfold.llm.components import components
from tallyfold.llm.shingles import MIX, _mixed, set_id, shingle_set
from tallyfold.session import written

BAND = 1.5  # ratio of the sizes in a band
HOT_LEAST, HOT_MOST = 64, 200_000  # documents that make a shingle common; most of those kept
BLOCK_SETS, BLOCK_SHINGLES = 2000, 2_000_000  # a cluster beyond either is split into blocks
LEAF, FAN = 16, 8  # sets in a leaf, children of a tree node
CODE, SINGLE = np.uint64(127), np.uint64(64)  # bits of a key: band and kind; a single shingle's
PAIRED = 64  # sets that share a key are paired, more are all linked with the smallest
SORTED_ROWS = 200_000  # sorted keys that are grouped at a time


class Routing:
    """Keys of which two sets share enough if their Jaccard similarity reaches p / q.

    Such sets differ in at most ``d = (n + m) * (q - p) / (q + p)`` shingles. The hash space
    is cut into ``k > d`` equal ranges; a differing shingle spoils one range, so at least
    ``k - d`` ranges hold exactly the same shingles in both sets, and a range's contents are
    its key. Ranges that are empty, or hold only common shingles, are weak and no keys. With ``k =
    most + 1 + spare`` ranges, ``most`` being the ``d`` of the largest sets of a band, a set with at
    most ``spare`` weak ones shares at least ``most + 1 - d`` keys with any such set (``enough``).
    Sets with more weak ranges, which are short or made of common shingles, also use their first
    ``n - p / q * n + 1`` shingles, the rarest first, as keys: any two such sets share one of
    these. ``k`` depends on the band of the smaller size; a set joins the bands that its
    possible smaller partners are in. The low bits of a key are its band and whether it is
    a single shingle.
    """

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        self.plan = lru_cache(maxsize=None)(self._plan)
        self.sizes = lru_cache(maxsize=None)(self._sizes)

    def __reduce__(self):
        return Routing, (self.p, self.q)

    @staticmethod
    def band(size: int) -> int:
        return int(math.log(size) / math.log(BAND) + 1e-9)

    def _sizes(self, band: int) -> tuple[int, int, int]:
        """The least and largest size of a band, and the most that a pair of it differs in."""
        low = max(1, math.ceil(BAND**band - 1e-6))
        while self.band(low) < band:
            low += 1
        high = max(low, math.ceil(BAND ** (band + 1)))
        while high > low and self.band(high) > band:
            high -= 1
        return low, high, (high + high * self.q // self.p) * (self.q - self.p) // (self.q + self.p)

    def _plan(self, band: int) -> tuple[int, int, np.ndarray]:
        """Ranges, spare ranges and range starts of a band."""
        low, _, most = self.sizes(band)
        ranges, spare = most + 1, 0
        for tried in range(most + 1, 2 * most + 2):
            empty = math.exp(-low / tried)
            weak = tried * empty + 3 * math.sqrt(tried * empty * (1 - empty)) + 1
            if tried - most - 1 >= weak:
                ranges, spare = tried, tried - most - 1
                break
        starts = (np.arange(ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
        return ranges, spare, starts

    def bands(self, size: int) -> range:
        return range(self.band(max(1, -(-size * self.p // self.q))), self.band(size) + 1)

    def keys(self, shingles: np.ndarray, common: np.ndarray, often: np.ndarray | None = None) -> np.ndarray:
        """The keys of a set; ``common`` are the sorted common shingles, ``often`` their counts."""
        found, counts = [], np.zeros(len(shingles), np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
            met = common[at] == shingles
            counts[met] = 1 if often is None else often[at[met]]
        rare = np.concatenate([[0], np.cumsum(counts == 0)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(shingles), dtype=np.uint64)])
        firsts = None
        for band in self.bands(len(shingles)):
            ranges, spare, starts = self.plan(band)
            cuts = np.append(np.searchsorted(shingles, starts), len(shingles))
            content = sums[cuts[1:]] - sums[cuts[:-1]]
            label = np.arange(ranges, dtype=np.uint64) + np.uint64(band << 40)
            keys = _mixed(content ^ _mixed(label * MIX + (cuts[1:] - cuts[:-1]).astype(np.uint64)))
            strong = rare[cuts[1:]] > rare[cuts[:-1]]
            found.append(keys[strong] & ~CODE | np.uint64(band))
            if ranges - strong.sum() > spare:
                if firsts is None:
                    size = len(shingles) - -(-len(shingles) * self.p // self.q) + 1
                    firsts = _mixed(shingles[np.lexsort((shingles, counts))[:size]])
                found.append(firsts & ~CODE | np.uint64(band) | SINGLE)
        return np.concatenate(found).view(np.int64)

    def enough(self, code: np.ndarray, shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether sets of ``n`` and ``m`` shingles with so many keys of a ``code`` in common may link.

        The keys that count are those of the smaller set's band.
        """
        small, large = np.minimum(n, m), np.maximum(n, m)
        code, top = code.astype(np.uint64), self.band(int(small.max(initial=1)))
        sizes = np.array([self.sizes(band) for band in range(top + 1)])
        band = np.searchsorted(sizes[:, 0], small, side="right") - 1
        apart = (small + large) * (self.q - self.p) // (self.q + self.p)
        least = np.maximum(1, sizes[band, 2] + 1 - apart)
        least[code & SINGLE > 0] = 1
        own = (code & CODE & ~SINGLE).astype(np.int64) == band
        return own & (large * self.p <= small * self.q) & (shared >= least)


class Tree:
    """A signature tree: nodes with the OR of their sets' bitmaps and their range of sizes.

    ``slack`` is the most shingles of a set beyond the bits they set. A set of a node shares at
    most its slack plus the bits common to both nodes with any set of the other.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, members: np.ndarray):
        self.members = members  # positions, by size
        slack = sizes[members] - np.bitwise_count(bitmaps[members]).sum(axis=1)
        starts = np.arange(0, len(members), LEAF)
        self.levels = [
            (
                np.bitwise_or.reduceat(bitmaps[members], starts, axis=0),
                np.minimum.reduceat(sizes[members], starts),
                np.maximum.reduceat(sizes[members], starts),
                np.maximum.reduceat(slack, starts),
            )
        ]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            starts = np.arange(0, len(bits), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, starts, axis=0), np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts), np.maximum.reduceat(slack, starts),
                )
            )

    def leaf(self, number: int) -> np.ndarray:
        return self.members[number * LEAF : (number + 1) * LEAF]

    def children(self, level: int, number: int) -> range:
        return range(number * FAN, min((number + 1) * FAN, len(self.levels[level - 1][0])))


class _Unions:
    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, a: int, b: int) -> None:
        a, b = sorted((self.label[a], self.label[b]))
        self.label[self.label == b] = a


def linked(sets: list[np.ndarray], sides: np.ndarray, p: int, q: int) -> list[tuple[int, int]]:
    """Links that join all sets which pairs of similarity ``p / q`` or more connect.

    Pairs on side 0 alone, or between sides 0 and 1 where both occur, are compared; pairs that
    earlier links connect already need no comparison. The trees are walked together from
    their roots; a pair of nodes is left out when no sets of such sizes, or none that share at
    most so many shingles, can reach the similarity.
    """
    sizes = np.array([len(s) for s in sets])
    width = 64
    while width < 4 * sizes.max():
        width *= 2
    bitmaps = np.zeros((len(sets), width), bool)
    for row, s in zip(bitmaps, sets):
        row[(s & np.uint64(width - 1)).astype(np.int64)] = True
    bitmaps = np.packbits(bitmaps, axis=1).view(np.uint64)
    order = np.argsort(sizes, kind="stable")
    left = Tree(sizes, bitmaps, order[sides[order] == 0])
    right = Tree(sizes, bitmaps, order[sides[order] == 1]) if (sides == 1).any() else left
    unions, links = _Unions(len(sets)), []

    def possible(a, b) -> bool:
        (bits_a, low_a, high_a, slack_a), (bits_b, low_b, high_b, slack_b) = a, b
        if high_a * q < p * low_b or high_b * q < p * low_a:
            return False
        shared = int(np.bitwise_count(bits_a & bits_b).sum()) + min(slack_a, slack_b)
        return min(shared, high_a, high_b) * (p + q) >= p * (low_a + low_b)

    def compare(a: np.ndarray, b: np.ndarray, same: bool) -> None:
        for i, x in enumerate(a):
            rest = b[i + 1 :] if same else b
            rest = rest[unions.label[rest] != unions.label[x]]
            if not len(rest):
                continue
            apart = np.bitwise_count(bitmaps[rest] ^ bitmaps[x]).sum(axis=1)
            total = sizes[rest] + sizes[x]
            for y in rest[apart * (p + q) <= total * (q - p)]:
                if unions.label[x] == unions.label[y]:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if q * both >= p * (sizes[x] + sizes[y] - both):
                    unions.join(x, y)
                    links.append((int(x), int(y)))

    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        level_a, a, level_b, b = stack.pop()
        node_a = [x[a] for x in left.levels[level_a]]
        node_b = [x[b] for x in right.levels[level_b]]
        if not possible(node_a, node_b):
            continue
        if not level_a and not level_b:
            compare(left.leaf(a), right.leaf(b), right is left and a == b)
            continue
        down_a = left.children(level_a, a) if level_a >= level_b else [a]
        down_b = right.children(level_b, b) if level_b >= level_a else [b]
        next_a, next_b = level_a - (level_a >= level_b), level_b - (level_b >= level_a)
        for x in down_a:
            for y in down_b:
                if right is left and level_a == level_b and a == b and x > y:
                    continue  # pairs within one node once
                stack.append((next_a, x, next_b, y))
    return links


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows from one pass over ``doc_id, text``: sets and locally common shingles.

    Kind 0: ``id`` is the document's, ``n`` the size of its set, ``node`` the id of the set (null
    if empty). Kind 1: shingle ``id`` is in ``n`` documents of a part of a task.
    """

    def run(batches):
        waiting, held = [], 0

        def common():
            ids, counts = np.unique(np.concatenate(waiting), return_counts=True)
            often = counts >= 4
            ids, counts = ids[often].view(np.int64), counts[often]
            return {"kind": np.ones(len(ids), int), "id": ids, "n": counts, "node": [None] * len(ids)}

        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
            yield {
                "kind": [0] * len(sets), "id": batch.column(0), "n": [len(s) for s in sets],
                "node": [set_id(s) if len(s) else None for s in sets],
            }
            waiting += sets
            held += sum(map(len, sets))
            if held > 2_000_000:
                yield common()
                waiting, held = [], 0
        if held:
            yield common()

    return map_batches(docs, run, "kind int, id long, n long, node long")


def shared_keys(batches):
    """From ``key, node`` in order: ``a, b, code, n``, pairs of nodes and how many keys they share.

    ``code`` is that of the keys. Where over ``PAIRED`` nodes share a key, each is paired with the
    smallest alone, under code -1.
    """

    def grouped(keys, nodes):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        place = np.arange(len(keys)) - np.repeat(starts, sizes)
        hot = np.repeat(sizes > PAIRED, sizes)
        rest = np.flatnonzero(hot & (place > 0))
        yield nodes[rest - place[rest]], nodes[rest], np.full(len(rest), -1)
        code = (keys.view(np.uint64) & CODE).astype(np.int64)
        rest = np.flatnonzero(~hot & (place > 0))
        step = 1
        while len(rest):
            yield nodes[rest - step], nodes[rest], code[rest]
            step += 1
            rest = rest[place[rest] >= step]

    def counted(pairs):
        a, b, code = (np.concatenate(x) for x in zip(*pairs))
        order = np.lexsort((code, b, a))
        a, b, code = a[order], b[order], code[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (code[1:] != code[:-1])
        starts = np.flatnonzero(np.append(True, new)) if len(a) else np.zeros(0, int)
        n = np.diff(np.append(starts, len(a)))
        for at in range(0, len(n), 50_000):
            part = starts[at : at + 50_000]
            yield {"a": a[part], "b": b[part], "code": code[part], "n": n[at : at + 50_000]}

    waiting, rows, pairs = [], 0, []

    def taken(last: bool) -> None:
        """Pairs the waiting rows; those of a key that may go on wait again, the first of a hot one."""
        keys, nodes = (np.concatenate(x) for x in zip(*waiting))
        new = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))
        keys, nodes = keys[new], nodes[new]
        start = np.searchsorted(keys, keys[-1])
        end = len(keys) if last or len(keys) - start > PAIRED else start
        pairs.extend(grouped(keys[:end], nodes[:end]))
        kept = slice(start, start + PAIRED + 1)
        waiting[:] = [(keys[kept], nodes[kept])]

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        rows += batch.num_rows
        if rows >= SORTED_ROWS:
            taken(False)
            rows = len(waiting[0][0])
            if sum(len(a) for a, _, _ in pairs) >= 5 * SORTED_ROWS:
                yield from counted(pairs)
                pairs.clear()
    if waiting:
        taken(True)
        yield from counted(pairs)


def candidate_edges(
    docs: DataFrame, nodes: DataFrame, words: int, routing: Routing, common: np.ndarray, often: np.ndarray
) -> DataFrame:
    """``a, b``: every pair of nodes that share so many keys that they may link.

    Of nodes under a key that very many share, each is paired with the smallest, so that all of
    them are in one component, without their pairs being formed.
    """
    shared = docs.sparkSession.sparkContext.broadcast((common, often))

    def run(batches):
        seen: set[int] = set()  # copies within a part of the task
        for batch in batches:
            keys, nodes = [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text, words)
                if not len(shingles) or (node := set_id(shingles)) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(node)
                keys.append(routing.keys(shingles, *shared.value))
                nodes.append(np.full(len(keys[-1]), node))
            if keys:
                yield {"key": np.concatenate(keys), "node": np.concatenate(nodes)}

    def close(batches):
        for batch in batches:
            a, b, code, n, n_a, n_b = (c.to_numpy() for c in batch.columns)
            kept = (code < 0) | routing.enough(code, n, n_a, n_b)
            yield {"a": a[kept], "b": b[kept]}

    rows = map_batches(docs, run, "key long, node long").repartition("key")
    pairs = map_batches(
        rows.sortWithinPartitions("key", "node"), shared_keys, "a long, b long, code int, n long"
    )
    pairs = pairs.groupBy("a", "b", "code").agg(F.sum("n").alias("n"))
    for name in ("a", "b"):
        sizes = nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"))
        pairs = pairs.join(sizes, name)
    pairs = pairs.select("a", "b", "code", "n", "n_a", "n_b")
    return map_batches(pairs, close, "a long, b long").distinct()


def link_edges(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, words: int, p: int, q: int) -> DataFrame:
    """``a, b``: links that connect the nodes of each cluster.

    ``nodes``: ``node, n, first_id``; ``clusters``: ``node, root``. A cluster larger than a block
    is split by a hash of the node, and each pair of blocks is one unit of work, so no task
    holds more than two blocks. Each node's text is read once, from its first document.
    """
    placed = nodes.join(clusters, "node")
    blocks = placed.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    placed = written(placed.join(blocks, "root"), "clustered")

    def sets(batches):
        for batch in batches:
            doc, texts, node, root, count = (c.to_pylist() for c in batch.columns)
            out = [(x, shingle_set(t, words), r, c) for t, x, r, c in zip(texts, node, root, count)]
            out = [o for o in out if set_id(o[1]) == o[0]]  # an id may stand for several texts
            yield {
                "node": [o[0] for o in out], "shingles": [o[1].tobytes() for o in out],
                "root": [o[2] for o in out], "blocks": [o[3] for o in out],
            }

    # Sorted and merged at every size, so that the plan at 100 TB is the one that small runs show.
    members = placed.withColumnRenamed("first_id", "doc_id").hint("merge")
    texts = docs.join(members, "doc_id")
    texts = texts.select("doc_id", "text", "node", "root", "blocks")
    found = map_batches(texts, sets, "node long, shingles binary, root long, blocks int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = found.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    units = units.select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "node", (F.col("own") > F.col("other")).cast("int").alias("side"), "shingles",
    )
    parts = units.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node")

    def join(batches):
        unit, rows = None, {}

        def links():
            # A block may be empty; pairs within the other one are those of its diagonal unit.
            sides = np.array([s for _, s in rows.values()])
            if len(rows) > 1 and (unit[1] == unit[2] or 0 < sides.sum() < len(sides)):
                ids = list(rows)
                arrays = [np.frombuffer(x, np.uint64) for x, _ in rows.values()]
                pairs = linked(arrays, sides, p, q)
                if pairs:
                    yield {"a": [ids[x] for x, _ in pairs], "b": [ids[y] for _, y in pairs]}

        for batch in batches:
            for root, i, j, node, side, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, j) != unit:
                    yield from links()
                    unit, rows = (root, i, j), {}
                rows[node] = (data, side)
        yield from links()

    return map_batches(parts, join, "a long, b long")


def join(
    docs: DataFrame, words: int = 5, p: int = 8, q: int = 10, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Two documents link when the Jaccard similarity of their shingle sets is at least ``p / q``;
    ``component_id`` is the smallest id that links reach. Documents without words, and with a
    null text, have an empty set and link with nothing. A null id has no component; such a row
    keeps its size but takes no part in links. Repeated rows are repeated; an id with several
    texts stands for each of them. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = written(shingled(source, words), "shingled")
    base = rows.filter("kind = 0").select(F.col("id").alias("doc_id"), "n", "node")
    usual = (
        rows.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_LEAST)
        .orderBy(F.desc("n"), "id").limit(HOT_MOST).toArrow()
    )
    common, often = usual["id"].to_numpy().view(np.uint64), usual["n"].to_numpy()
    order = np.argsort(common)
    common, often = common[order], often[order]
    named = source.filter("doc_id IS NOT NULL")
    nodes = written(
        base.filter("doc_id IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(F.max("n").alias("n"), F.min("doc_id").alias("first_id")),
        "nodes",
    )
    clusters = components(candidate_edges(named, nodes, words, Routing(p, q), common, often))
    linked_nodes = components(link_edges(named, nodes, written(clusters, "clusters"), words, p, q))
    roots = nodes.join(linked_nodes, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    roots = written(roots, "roots")
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = roots.join(least, "root").select("node", "component_id")
    return base.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_each(docs: DataFrame, joined: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: of each component the document with the smallest id.

    ``joined`` is the result of ``join`` over ``docs``. Of repeated rows of an id one stays, the
    text with the smallest hash. Rows with a null id are not linked and all stay.
    """
    first, copy = (f"{name}_{len(''.join(docs.columns))}_" for name in ("first", "copy"))
    firsts = joined.filter("doc_id = component_id").select(F.col("doc_id").alias(first)).distinct()
    named = docs.filter(F.col(doc_id).isNotNull())
    once = Window.partitionBy(first).orderBy(F.xxhash64(text))
    kept = (
        named.join(firsts, F.col(doc_id).cast("long") == F.col(first))
        .withColumn(copy, F.row_number().over(once))
        .filter(F.col(copy) == 1)
        .select(*docs.columns)
    )
    return kept.union(docs.filter(F.col(doc_id).isNull()))
