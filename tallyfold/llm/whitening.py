"""Whitening of embeddings with covariances over the distinct vectors.

Vectors are rounded to whole steps first, so equal ones can be grouped: each distinct vector enters
the fit once, with its count or one as its weight, is whitened once, and joined back to its rows.
Sums are exact integers; products are matrix products of centred blocks, added up by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import written

#: Fixed values of the contract: x = floor(STEPS * c) + OFFSET.
STEPS = 64
OFFSET = 1_000_000
#: Steps are clamped to this; entries beyond some 16 million are far outside any embedding.
LARGEST = (1 << 30) - 1
#: Vectors of one block of a matrix product.
BLOCK_ROWS = 4096
#: Components whose eigenvalue is below this share of the trace have no direction of their own.
LEAST_SHARE = 1e-12
LONG_MOST = float(1 << 63)


def stepped(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, y`` of vectors without null or non-finite entries; ``y`` is x less the offset.

    The most frequent length counts (the longer one in a tie); empty vectors and those of other
    lengths take no part, since a covariance needs one length.
    """
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def step(c: Column) -> Column:
        steps = F.floor(c.cast("double") * STEPS)
        return F.greatest(F.least(steps, F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("c"))
    rows = rows.filter(F.col("c").isNotNull() & F.forall("c", finite) & (F.size("c") > 0))
    rows = rows.select("vec_id", F.transform("c", step).alias("y"))
    lengths = rows.groupBy(F.size("y").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("y") == (common["length"] if common else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width)


def _blocks(batches, width: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, _matrix(part.column(0), width), part.column(1).to_numpy()


def sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Total weight and the exact weighted sum of every dimension."""

    def run(batches):
        total, parts = 0, [0] * width
        for _, y, weight in _blocks(batches, width):
            total += int(weight.sum())
            # Split so that no product of an entry and a weight overflows.
            low, high = y & 0xFFFF, y >> 16
            for d in range(width):
                parts[d] += int((low[:, d] * weight).sum()) + (int((high[:, d] * weight).sum()) << 16)
        places = pa.array(range(-1, width), pa.int32())
        values = pa.array([str(v) for v in (total, *parts)], pa.string())
        yield pa.RecordBatch.from_arrays([places, values], names=["d", "v"])

    wide = fit.select(F.col("y").cast("array<long>"), "weight")
    parts = wide.mapInArrow(run, "d int, v string")
    found = parts.groupBy("d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r["d"]: int(r["v"]) for r in found.collect()}
    return found.get(-1, 0), [found.get(d, 0) for d in range(width)]


def covariance(fit: DataFrame, width: int, centre, total: int) -> np.ndarray:
    """Weighted covariance over ``fit`` (vector column first, then weight), divisor ``total``.

    ``centre`` maps a block to its centred values; only then are they multiplied. A task gives one
    partial matrix, whose entries Spark adds up: ``width`` squared, whatever the rows.
    """

    def run(batches):
        whole = np.zeros((width, width))
        for _, block, weight in _blocks(batches, width):
            centred = centre(block)
            whole += (centred * weight[:, None]).T @ centred
        at = np.arange(width * width)
        columns = [pa.array(at, pa.int64()), pa.array(whole.ravel(), pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "v"])

    parts = fit.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    matrix = np.zeros(width * width)
    for row in parts.collect():
        matrix[row["at"]] = row["v"]
    return matrix.reshape(width, width) / max(total, 1)


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = 16,
    weights: str = "one",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector.

    ``weights`` is ``one`` (each distinct vector counts once) or ``count`` (as often as it
    occurs). Rows whose vector is null or holds null or non-finite entries are left out, also
    empty ones and those that do not have the most frequent length; repeated rows and ids each
    give their rows. Components without variance, as with fewer distinct vectors than
    components, are left out, so equal vectors alone, like an empty table, give no rows. Entries
    beyond 16 million are clamped, and a ``deviation`` that no long can hold is null.

    The driver holds the covariance, which has the vectors' length squared, never vectors.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights is 'one' or 'count'")
    rows = stepped(vectors, vec_id, embedding)
    weight = F.lit(1).cast("long") if weights == "one" else F.count(F.lit(1))
    fit = written(rows.groupBy("y").agg(weight.alias("weight")), "distinct-vectors")
    first = fit.first()
    width = len(first["y"]) if first else 1
    total, summed = sums(fit, width)
    whole = np.array(summed, dtype=object)
    mean_steps = np.array([s // max(total, 1) for s in summed], dtype=np.int64)
    rest = np.array([int(s % max(total, 1)) / max(total, 1) for s in summed])

    def centre(block):
        return (block.astype(np.int64) - mean_steps) - rest

    values, vectors_ = np.linalg.eigh(covariance(fit, width, centre, total))
    trace = float(values.sum())
    order = [i for i in np.argsort(-values) if values[i] > LEAST_SHARE * max(trace, 0.0)][:components]
    axes, kept = vectors_[:, order], values[order]
    scaled = axes / np.sqrt(kept)
    k = len(order)

    def run(batches):
        for part, block, weight_ in _blocks(batches, width):
            white = centre(block) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(weight_, pa.int64()),
                    pa.array(_deviations(block, total, whole), pa.int64()),
                    pa.array(list(white) if k else [[]] * len(block), pa.list_(pa.float64())),
                ],
                names=["y", "weight", "deviation", "w"],
            )

    schema = "y array<int>, weight long, deviation long, w array<double>"
    done = written(fit.mapInArrow(run, schema), "white-vectors")
    error = _identity_error(done.select("w", "weight"), k, total)
    share = [float(v / trace) for v in kept]
    each = rows.join(done.select("y", "deviation", "w"), "y")
    at = F.col("at") + 1
    return each.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        at.alias("component"),
        F.lit(total).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, share or [0.0])), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _deviations(block: np.ndarray, total: int, summed: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n * x - S) ** 2``, exact; the offset cancels out."""
    about = block.astype(np.float64) * total - summed.astype(np.float64)
    rough = (about * about).sum(axis=1)
    largest = np.abs(about).max(initial=0.0)
    if rough.max(initial=0.0) < LONG_MOST / 4 and largest < float(1 << 52):
        exact = block.astype(np.int64) * total - summed.astype(np.int64)
        return (exact * exact).sum(axis=1).tolist()
    found = []
    for row in block.tolist():
        value = sum((y * total - int(s)) ** 2 for y, s in zip(row, summed))
        found.append(value if value < 1 << 63 else None)
    return found


def _identity_error(white: DataFrame, k: int, total: int) -> float:
    """Largest absolute entry of the whitened covariance less the identity."""
    if not k:
        return 0.0
    means = [F.sum(F.get("w", F.lit(i)) * F.col("weight")) / total for i in range(k)]
    mean = np.array(white.agg(*means).first(), dtype=np.float64)
    matrix = covariance(white, k, lambda block: block - mean, total)
    return float(np.abs(matrix - np.eye(k)).max())
