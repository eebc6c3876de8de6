"""Quality classifier: Bradley-Terry scores learned from preference pairs."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import id_remainder, keep_rows, map_batches
from tallyfold.session import written

SAMPLE_ROWS = 8000  # labelled documents of each class that a fit reads, on average
PAIRS = 60_000  # preference pairs drawn from them
CUT = 0.3  # predicted 1 from this score on
SYMBOLS = b"#*$%&<>~^_=+\\/@"


def _class_matrix() -> np.ndarray:
    """Byte values (Latin-1) by kind: capitals, digits, marks, symbols, bars, calls, unknown."""
    kinds = np.zeros((256, 8))
    kinds[[*range(65, 91), *range(192, 215), *range(216, 223)], 0] = 1
    kinds[48:58, 1] = 1
    kinds[[ord(c) for c in ".,;:'\"()-"], 2] = 1
    kinds[list(SYMBOLS), 3] = 1
    kinds[ord("|"), 4] = 1
    kinds[ord("!"), 5] = 1
    kinds[ord("?"), 6] = 1  # also letters outside Latin-1
    kinds[[32, *range(9, 14)], 7] = 1
    return kinds


KINDS = _class_matrix()
RATES = 14  # features that are shares; each also enters as its square root
FEATURES = 2 * RATES + 4


def features(texts: list[str]) -> np.ndarray:
    """A row of numbers per whole text; an empty text has zeros."""
    found = np.zeros((len(texts), FEATURES))
    for row, text in zip(found, texts):
        words = text.split()
        if not words:
            continue
        n = len(words)
        counts = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
        kinds = counts @ KINDS
        solid = max(1.0, len(text) - kinds[7])
        lines = [line for line in text.split("\n") if line and not line.isspace()]
        by_word = Counter(words)
        after = words[1:]
        rates = row[:RATES]
        rates[:7] = kinds[:7] / solid
        rates[7] = sum(map(eq, words, after)) / n
        rates[8] = max(by_word.values()) / n
        rates[9] = 1 - len(set(zip(words, after))) / max(1, n - 1) if n > 1 else 0.0
        rates[10] = 1 - len(set(lines)) / max(1, len(lines))
        rates[11] = sum(c for w, c in by_word.items() if len(w) == 1 and not w.isalnum()) / n
        rates[12] = sum(c for w, c in by_word.items() if len(w) > 20) / n
        rates[13] = sum(c for w, c in by_word.items() if not w[-1].isalnum() and len(w) > 2 and not w[-2].isalnum()) / n
        row[RATES : 2 * RATES] = np.sqrt(np.maximum(rates, 0))
        row[2 * RATES :] = (
            math.log1p(n), solid / n, math.log1p(len(by_word)) / math.log1p(n),
            math.log1p(n / max(1, len(lines))),
        )
    return found


@dataclass
class Model:
    """Weights of the standardised features, the cutoff, and the slope of the score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cutoff: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; documents at the cutoff get ``CUT``."""
        odds = self.slope * (self.raw(x) - self.cutoff) + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def ranked(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 0) -> Model:
    """Bradley-Terry weights: logistic loss on feature differences of (better, worse) pairs.

    Pairs are drawn from the two classes. The cutoff is the quantile of the fitted scores with
    the least errors. With a class missing, every score is ``CUT``.
    """
    if not len(x):
        x = np.zeros((1, FEATURES))
        y = np.ones(1)
    # A floor on the spread, so that a feature that is constant here cannot outweigh the others.
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)
    model = Model(mean, spread, np.zeros(x.shape[1]), 0.0, 1.0)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        return model
    rng = np.random.default_rng(seed)
    z = np.clip((x - mean) / spread, -8, 8)
    gap = z[rng.choice(better, pairs)] - z[rng.choice(worse, pairs)]
    first, second = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    weights = np.zeros(z.shape[1])
    for step in range(1, 401):  # Adam on the whole set of pairs
        lost = 1 / (1 + np.exp(np.clip(gap @ weights, -50, 50)))
        gradient = -(lost @ gap) / pairs + 1e-4 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    model.weights = weights
    raw = model.raw(x)
    model.cutoff = _cutoff(raw[better], raw[worse])
    # A slope at which the bulk of either class lies clearly on its side.
    width = (np.quantile(raw[better], 0.25) - np.quantile(raw[worse], 0.75)) / 2
    model.slope = 4.0 / max(width, 0.5)
    return model


def _cutoff(better: np.ndarray, worse: np.ndarray, price: float = 2.0) -> float:
    """The score quantile with the least errors; a rejected good document costs ``price``."""
    levels = np.unique(np.quantile(np.concatenate([better, worse]), np.linspace(0, 1, 2001)))
    middle = np.concatenate([[levels[0] - 1], (levels[1:] + levels[:-1]) / 2])
    wrong_good = np.searchsorted(np.sort(better), middle) / len(better)
    wrong_bad = 1 - np.searchsorted(np.sort(worse), middle) / len(worse)
    total = price * wrong_good + wrong_bad
    best = np.flatnonzero(total <= total.min() + 1e-12)
    return float(middle[best[len(best) // 2]])


def fitted(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS
) -> Model:
    """A model of ``labels`` (``doc_id, quality``) on a bounded sample of about ``rows`` each.

    Labels of ids whose crc32 as text is divisible by five are never read. A document with
    several labels has the lowest. The sample is chosen by a hash of the id; of an id's rows
    the text with the least hash stands, so repeated rows add nothing to what is gathered.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .filter(id_remainder(F.col("doc_id"), 5) != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    marks = written(marks, "marks")
    counts = {r.quality: r["count"] for r in marks.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for quality, n in counts.items():
        share = F.when(F.col("quality") == quality, min(1.0, rows / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = marks.filter(draw < share)  # about 2 * rows ids, whatever the input

    def run(batches):
        for batch in batches:
            x = features([t or "" for t in batch.column(0).to_pylist()])
            yield {"quality": batch.column(1), "x": list(x)}

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    source = source.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min_by(F.struct("text", "quality"), F.xxhash64("text")).alias("one")
    ).select("one.*")
    found = map_batches(source, run, "quality int, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist(), float).reshape(found.num_rows, FEATURES)
    y = np.array(found["quality"].to_pylist(), float)
    order = np.lexsort((*x.T, y))  # rows arrive in any order
    return ranked(x[order], y[order])


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; null and empty texts have the empty text's."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = features([t or "" for t in batch.column(1).to_pylist()])
            yield {"doc_id": batch.column(0), "score": shared.value.scores(x)}

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``CUT`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def good(batch):
        x = features([t or "" for t in batch.column(0).to_pylist()])
        return (shared.value.scores(x) >= CUT).tolist()

    return keep_rows(docs, [text], good)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Repeated rows are scored alike; other columns are not read. Without labels of both
    classes every document scores ``CUT`` and is predicted 1.
    """
    found = scored(docs, fitted(docs, labels, doc_id, text), doc_id, text)
    held = id_remainder(F.col("doc_id"), 5) == 0
    return found.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
