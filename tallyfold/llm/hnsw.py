"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import written

SHARD_ROWS = 4096  # distinct vectors in a shard's graph
GROUP_ROWS = 16384  # queries that one search task holds
LINKS = 12  # neighbours per node above the ground layer; twice as many on it
BUILD_WIDTH, SEARCH_WIDTH = 48, 96


class Graph:
    """Flat neighbour arrays: ``links[layer]`` is an int32 row per node, -1 where unused."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray] | None = None, entry: int = 0):
        self.vectors, self.links, self.entry = vectors, links or [], entry
        self.norms = np.einsum("ij,ij->i", vectors, vectors)

    def _distances(self, query: np.ndarray, norm: float, nodes) -> list[float]:
        return (self.norms[nodes] - 2.0 * (self.vectors[nodes] @ query) + norm).tolist()

    def layer(self, query, norm, starts, width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes that a best-first walk of one layer finds."""
        seen = {node for _, node in starts}
        open_, best = list(starts), [(-d, node) for d, node in starts]
        heapq.heapify(open_)
        heapq.heapify(best)
        links = self.links[level]
        while open_:
            distance, node = heapq.heappop(open_)
            if len(best) >= width and distance > -best[0][0]:
                break
            fresh = [x for x in links[node].tolist() if x >= 0 and x not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for d, x in zip(self._distances(query, norm, fresh), fresh):
                if len(best) < width:
                    heapq.heappush(best, (-d, x))
                    heapq.heappush(open_, (d, x))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, x))
                    heapq.heappush(open_, (d, x))
        return sorted((-d, node) for d, node in best)

    def search(self, query: np.ndarray, width: int = SEARCH_WIDTH) -> list[tuple[float, int]]:
        norm = float(query @ query)
        starts = [(self._distances(query, norm, [self.entry])[0], self.entry)]
        for level in range(len(self.links) - 1, 0, -1):
            starts = self.layer(query, norm, starts, 1, level)[:1]
        return self.layer(query, norm, starts, width, 0)


def _spread(graph: Graph, near: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours in different directions: none closer to a chosen one than to the node."""
    nodes = [x for _, x in near]
    own = graph.vectors[nodes]
    norms = graph.norms[nodes]
    between = norms[:, None] + norms[None, :] - 2.0 * (own @ own.T)
    chosen: list[int] = []
    for i, (distance, _) in enumerate(near):
        if len(chosen) == most:
            break
        if not chosen or between[i, chosen].min() >= distance:
            chosen.append(i)
    if len(chosen) < most:  # fill up with the nearest of the others
        chosen += [i for i in range(len(near)) if i not in set(chosen)][: most - len(chosen)]
    return [nodes[i] for i in chosen]


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 0) -> Graph:
    """A graph over the rows of ``vectors``, inserted in order."""
    count = len(vectors)
    draws = np.random.default_rng(seed).random(count)
    levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / math.log(links)).astype(int), 12)
    top = int(levels.max(initial=0))
    room = [2 * links if level == 0 else links for level in range(top + 1)]
    graph = Graph(vectors, [np.full((count, room[level]), -1, np.int32) for level in range(top + 1)])
    highest = int(levels[0]) if count else 0
    for node in range(1, count):
        query, norm, level = vectors[node], float(graph.norms[node]), int(levels[node])
        starts = [(graph._distances(query, norm, [graph.entry])[0], graph.entry)]
        for upper in range(highest, level, -1):
            starts = graph.layer(query, norm, starts, 1, upper)[:1]
        for lower in range(min(level, highest), -1, -1):
            starts = graph.layer(query, norm, starts, width, lower)
            own, table = _spread(graph, starts, links), graph.links[lower]
            table[node, : len(own)] = own
            for other in own:
                row = table[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                    continue
                nodes = [*row.tolist(), node]
                distances = graph._distances(vectors[other], float(graph.norms[other]), nodes)
                kept = _spread(graph, sorted(zip(distances, nodes)), room[lower])
                row[: len(kept)] = kept
        if level > highest:
            highest, graph.entry = level, node
    return graph


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, embedding`` of finite, non-zero vectors with an id; repeated rows once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(embedding).cast("array<float>").alias("embedding"),
        )
        .filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .filter(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
        .distinct()
    )


def indexed(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """The graphs as a table of flat arrays, a row per shard; and the shards of each length.

    Equal vectors are one node, which lists its ``k + 1`` smallest ids: more can never be among
    the ``k`` nearest of a query. So a vector that a third of all rows share is cut to ``k + 1``
    rows before the shuffle and cannot crowd a graph. Vectors of different length are never
    compared: shards are per length. Every row is indexed.
    """
    spark = rows.sparkSession
    order = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = written(
        rows.withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("dim", F.size("embedding")),
        "nodes",
    )
    shards = written(
        nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards")),
        "shards",
    )
    placed = nodes.join(shards, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int")
    )

    def graph_of(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(first=[x[0] for x in frame["ids"]]).sort_values("first")
        matrix = np.array(frame["embedding"].tolist(), np.float32)
        graph = build(matrix)
        sizes = [len(x) for x in frame["ids"]]
        return pd.DataFrame(
            [
                {
                    "dim": int(key[0]), "shard": int(key[1]), "entry": graph.entry,
                    "vectors": matrix.tobytes(),
                    "links": [x.astype("<i4").tobytes() for x in graph.links],
                    "ids": np.concatenate(frame["ids"].tolist()).astype("<i8").tobytes(),
                    "sizes": np.array(sizes, "<i4").tobytes(),
                }
            ]
        )

    schema = (
        "dim int, shard int, entry int, vectors binary, links array<binary>, ids binary, "
        "sizes binary"
    )
    # A task for every shard: building is work for the processor, however few the bytes.
    total = shards.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]
    placed = placed.repartition(int(total), "dim", "shard")
    graphs = placed.groupBy("dim", "shard").applyInPandas(graph_of, schema)
    return written(graphs, "graphs"), shards


def nearest(
    vectors: DataFrame,
    queries: str,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every query.

    ``queries`` is a condition on ``vec_id``. Null, zero and non-finite vectors and null ids
    take no part. Distances are Euclidean in double precision on the given vectors; ties go to
    the smaller id. Each task searches one shard's graph for a bounded group of queries, so
    neither queries nor graphs are ever whole in one place.
    """
    rows = written(usable(vectors, vec_id, embedding), "vectors")
    graphs, shards = indexed(rows, k, shard_rows)
    asked = rows.filter(queries).withColumn("dim", F.size("embedding"))
    groups = asked.count() // GROUP_ROWS + 1
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    asked = asked.join(shards, "dim").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    )
    parts = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(index: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if index.empty or group.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        row = index.iloc[0]
        matrix = np.frombuffer(row["vectors"], np.float32).reshape(-1, int(row["dim"]))
        links = [np.frombuffer(x, "<i4").reshape(len(matrix), -1) for x in row["links"]]
        graph = Graph(matrix, links, int(row["entry"]))
        ids = np.frombuffer(row["ids"], "<i8")
        ends = np.cumsum(np.frombuffer(row["sizes"], "<i4"))
        exact = matrix.astype(np.float64)
        found = []
        for query_id, vector in zip(group["vec_id"], group["embedding"]):
            query = np.asarray(vector, np.float32)
            nodes = np.array([x for _, x in graph.search(query, max(SEARCH_WIDTH, 2 * k))])
            apart = exact[nodes] - query.astype(np.float64)
            score = np.sqrt((apart * apart).sum(axis=1))
            own = []
            for i in np.argsort(score, kind="stable"):
                if len(own) > k and score[i] > own[-1][0]:
                    break
                node = int(nodes[i])
                members = ids[(ends[node - 1] if node else 0) : ends[node]]
                own += [(float(score[i]), int(x)) for x in members if x != query_id]
            found += [(query_id, x, d) for d, x in sorted(own)[:k]]
        return pd.DataFrame(found, columns=names)

    keys = ["dim", "shard", "part"]
    tasks = int(shards.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]) * groups
    hits = (
        parts.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(
            asked.select(*keys, "vec_id", "embedding").repartition(tasks, *keys).groupBy(*keys)
        )
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
