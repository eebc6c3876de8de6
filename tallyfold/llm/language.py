"""Language ID with interpolated Kneser-Ney character models."""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import id_remainder, keep_rows, map_batches
from tallyfold.session import written

ORDER = 4  # characters of the longest grams
SAMPLE_ROWS = 2000  # labelled documents per language, on average, that a fit reads
MAX_GRAMS = 400_000  # grams of a language's model
MAX_LANGS = 200  # languages of a model
FALSE_REJECTIONS = 1e-4  # aimed at share of own texts beyond a limit; heavier tails exceed it
POOLED = 20  # documents that the limit of all languages counts as beside a language's own
CACHED = 300_000  # words whose scores a worker remembers
LONG = 40  # longer words are scored but not remembered
MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` code points, by their first position."""
    count = len(points) - size + 1
    found = np.full(max(count, 0), np.uint64(size))
    for at in range(size):
        found = (found ^ points[at : at + count].astype(np.uint64)) * MIX
        found ^= found >> np.uint64(29)
    return found


def gram_counts(texts, order: int) -> Counter:
    """Counts of the grams of words, each word between two spaces."""
    words = Counter()
    for text in texts:
        words.update(text.lower().split())
    grams = Counter()
    for word, n in words.items():
        padded = f" {word} "
        for size in range(1, order + 1):
            for at in range(len(padded) - size + 1):
                if size > 1 or at:  # the first space is never predicted
                    grams[padded[at : at + size]] += n
    return grams


class Model:
    """Log-probabilities and back-off weights of all languages in sorted hash arrays.

    For every gram size there is one sorted array of hashes and a matrix with a column per
    language; a gram that a language lacks is NaN there and costs that language the back-off
    weight of its context, found in a second pair of arrays.
    """

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER):
        self.langs, self.order = sorted(counts), order
        letters = {g for c in counts.values() for g in c if len(g) == 1}
        self.floor = -np.log(len(letters) + 1.0)
        found = [self._kneser_ney(counts[lang], len(letters) + 1) for lang in self.langs]
        self.grams, self.contexts = [], []
        for size in range(1, order + 1):
            self.grams.append(self._table([f[0] for f in found], size))
            self.contexts.append(self._table([f[1] for f in found], size - 1))
        self.usual = np.zeros(len(self.langs))  # median cross-entropy of calibration documents
        self.limits = np.full(len(self.langs), np.inf)

    def _kneser_ney(self, counts, letters):
        """Interpolated log-probability by gram and log back-off weight by context."""
        left = Counter(g[1:] for g in counts if len(g) > 1)  # distinct letters to the left
        used = {
            g: n if len(g) == self.order or g[0] == " " else left[g]
            for g, n in counts.items()
        }
        used = {g: n for g, n in used.items() if n}
        prob, weight = {}, {"": 0.0}
        for size in range(1, self.order + 1):
            own = {g: n for g, n in used.items() if len(g) == size}
            ones = sum(n == 1 for n in own.values())
            twos = sum(n == 2 for n in own.values())
            cut = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            total, kinds = Counter(), Counter()
            for g, n in own.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            for h, t in total.items():
                weight[h] = np.log(cut * kinds[h] / t)
            for g, n in own.items():
                h = g[:-1]
                lower = np.exp(prob[g[1:]]) if size > 1 and g[1:] in prob else 1.0 / letters
                prob[g] = np.log((n - cut) / total[h] + np.exp(weight[h]) * lower)
        return prob, weight

    def _table(self, tables, size):
        grams = sorted({g for t in tables for g in t if len(g) == size})
        points = [np.array([ord(c) for c in g], np.uint32) for g in grams]
        hashes = (
            np.concatenate([gram_hashes(p, size) for p in points])
            if size and grams
            else np.zeros(len(grams), np.uint64)
        )
        values = np.array([[t.get(g, np.nan) for t in tables] for g in grams], np.float32)
        order = np.argsort(hashes)
        return hashes[order], values.reshape(len(grams), len(tables))[order]

    @staticmethod
    def _find(table, hashes):
        known, values = table
        if not len(known):
            return np.full((len(hashes), values.shape[1]), np.nan, np.float32)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where((known[at] == hashes)[:, None], values[at], np.float32(np.nan))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per word: the log-probability in every language, and the characters predicted."""
        sizes = np.array([len(w) + 1 for w in words])
        points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes + 1) - sizes - 1
        place = np.arange(len(points)) - np.repeat(starts, sizes + 1)  # within the padded word
        ends = np.flatnonzero(place)  # every character but a word's first space is predicted
        score = np.zeros((len(ends), len(self.langs)), np.float32)
        done = np.zeros(score.shape, bool)
        for size in range(self.order, 0, -1):
            fits = place[ends] >= size - 1
            at = ends[fits] - size + 1
            value = self._find(self.grams[size - 1], gram_hashes(points, size)[at])
            open_ = ~done[fits]
            hit = open_ & ~np.isnan(value)
            miss = open_ & ~hit
            back = np.zeros(value.shape, np.float32)
            if miss.any():
                if size > 1:
                    back = self._find(self.contexts[size - 1], gram_hashes(points, size - 1)[at])
                else:
                    back = np.full(value.shape, np.float32(self.floor)) + np.nan_to_num(
                        self.contexts[0][1][:1]
                    )
            score[fits] += np.where(hit, value, np.where(miss, np.nan_to_num(back), 0))
            done[fits] |= hit
        first = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(score, first, axis=0)
        return np.concatenate([sums, sizes[:, None].astype(np.float32)], axis=1)


class Scorer:
    """Scores texts by their words, whose scores it remembers up to a bound."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.rows = np.zeros((0, len(model.langs) + 1), np.float32)

    def sums(self, texts: list[str]) -> np.ndarray:
        """Per text: summed log-probabilities by language, and characters."""
        split = [t.lower().split() for t in texts]
        fresh = {w for words in split for w in words} - self.index.keys()
        if len(self.index) + len(fresh) > CACHED:
            self.index, self.rows = {}, self.rows[:0]
            fresh = {w for words in split for w in words}
        kept = [w for w in fresh if len(w) <= LONG]
        new = kept + [w for w in fresh if len(w) > LONG]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.index.update(zip(part, range(len(self.rows), len(self.rows) + len(part))))
            self.rows = np.concatenate([self.rows, self.model.word_scores(part)])
        out = np.zeros((len(texts), self.rows.shape[1]))
        for i, words in enumerate(split):
            if words:
                found = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
                counts = np.bincount(found) if len(words) > 20_000 else None
                if counts is None:
                    out[i] = self.rows[found].sum(axis=0, dtype=np.float64)
                else:
                    out[i] = counts @ self.rows[: len(counts)].astype(np.float64)
        if len(new) > len(kept):
            for word in new[len(kept) :]:
                del self.index[word]
            self.rows = self.rows[: len(self.rows) - len(new) + len(kept)]
        return out


#: The scorer of the model that this worker used last, by the model's key.
_SCORERS: dict[str, Scorer] = {}


def _scorer(key: str, shared) -> Scorer:
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


def sampled(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` documents of each language (exactly all where there are fewer).

    Chosen by a hash of id and text; repeated rows count once. ``lang`` values with fewer than two documents, and those beyond
    the ``MAX_LANGS`` most frequent, are left out.
    """
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    counts = {r.lang: r["count"] for r in frequent.collect()}
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(1.0, rows / n) if n > 1 else 0.0).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.withColumn("draw", draw).filter(F.col("draw") < share).drop("draw")
    return chosen.dropDuplicates(["doc_id", "text", "lang"])


def fitted(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    rows: int = SAMPLE_ROWS,
    max_grams: int = MAX_GRAMS,
    rate: float = FALSE_REJECTIONS,
) -> Model:
    """A model of every language that labelled documents name.

    Learns from a sample of about ``rows`` documents per language among those with text, a
    label, and crc32 of the id modulo 4 other than 2. Three quarters give the gram counts,
    which Spark adds up; a quarter calibrates rejection: the limit is the excess
    over the median cross-entropy that a share ``rate`` of a language's documents is beyond, by
    ``tail_limit``. The limit of all languages together counts in each as ``POOLED`` documents,
    so it decides where a language has few. Beyond ``max_grams`` per language the rarest grams are left out.
    """
    labelled = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    labelled = labelled.filter(id_remainder(F.col("doc_id"), 4) != 2)
    sample = sampled(labelled, rows).withColumn(
        "held", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    )
    sample = written(sample, "language-sample")

    def count(batches):
        by: dict[str, Counter] = {}
        for batch in batches:
            texts: dict[str, list] = {}
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(name, []).append(value)
            for name, values in texts.items():
                by.setdefault(name, Counter()).update(gram_counts(values, order))
        for name, grams in by.items():
            items = list(grams.items())
            for at in range(0, len(items), 50_000):
                part = items[at : at + 50_000]
                yield {"lang": [name] * len(part), "gram": [g for g, _ in part], "n": [n for _, n in part]}

    source = sample.filter("NOT held").select("text", "lang")
    grams = written(
        map_batches(source, count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    bands = grams.groupBy("lang", F.floor(F.log2("n")).cast("int").alias("band")).count().collect()
    least: dict[str, int] = {}
    for name in {r.lang for r in bands}:
        left, cut = 0, 63
        for row in sorted((r for r in bands if r.lang == name), key=lambda r: -r.band):
            if left + row["count"] > max_grams:
                break
            left, cut = left + row["count"], row.band
        least[name] = cut
    counts: dict[str, dict[str, int]] = {}
    for name, cut in least.items():
        kept = grams.filter((F.col("lang") == name) & (F.col("n") >= F.lit(1 << min(cut, 62))))
        found = kept.select("gram", "n").toArrow()
        counts[name] = dict(zip(found["gram"].to_pylist(), found["n"].to_pylist()))
    model = Model(counts, order)
    if model.langs:
        held = scored(sample.filter("held"), model, "doc_id", "text", "lang")
        held = held.select("label", "lang_pred", "cross_entropy", "chars").toPandas()
        own = held[held["label"] == held["lang_pred"]]
        calibrate(model, own["lang_pred"], own["cross_entropy"], own["chars"], rate)
    return model


def calibrate(model: Model, langs, cross_entropy, chars, rate: float = FALSE_REJECTIONS) -> None:
    """Set a model's usual cross-entropies and limits from documents of known language.

    A language without a document here has the median of the others' usual values and the pooled
    limit. Where no language has two documents that differ, no limit is known and none is set.
    """
    langs, cross_entropy, chars = map(np.asarray, (langs, cross_entropy, chars))
    rows = [np.flatnonzero(langs == name) for name in model.langs]
    known = [float(np.median(cross_entropy[r])) for r in rows if len(r)]
    if not known:
        return
    model.usual[:] = [np.median(cross_entropy[r]) if len(r) else np.median(known) for r in rows]
    found = [excess(cross_entropy[r], chars[r], u) for r, u in zip(rows, model.usual)]
    several = np.concatenate([[], *(f for f in found if len(f) > 1)])
    if not several.any():
        return
    pooled = tail_limit(several, rate)
    for i, f in enumerate(found):
        own = tail_limit(f, rate) if len(f) else 0.0
        model.limits[i] = (len(f) * own + POOLED * pooled) / (len(f) + POOLED)


def tail_limit(found: np.ndarray, rate: float) -> float:
    """The excess that a share ``rate`` of documents is beyond.

    By the exponential tail through the median and the 90th percentile, so that the worst tenth
    (junk, wrong labels) does not move it.
    """
    middle, high = np.quantile(found, [0.5, 0.9])
    if high <= 0:  # more than nine tenths alike: only the largest tells how texts differ
        return float(found.max())
    return float(high + (high - middle) * np.log(0.1 / rate) / np.log(0.5 / 0.1))


def excess(cross_entropy, chars, usual):
    """Cross-entropy above the usual; less weight to texts of under 200 characters."""
    return np.maximum(0, cross_entropy - usual) * np.minimum(1, np.sqrt(chars / 200))


def _judge(docs: DataFrame, model: Model):
    """A function from texts to columns, for use inside tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, limits, usual = model.langs, model.limits, model.usual
    key = uuid.uuid4().hex

    def judge(values) -> dict:
        texts = [t or "" for t in values]
        sums = _scorer(key, shared).sums(texts)
        mean = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        known = np.array([any(map(str.isalpha, t)) for t in texts], bool) & bool(names)
        if names:
            best = mean.argmax(axis=1)
            top = mean[np.arange(len(texts)), best]
            share = 1 / np.exp(10 * (mean - top[:, None])).sum(axis=1)
        else:
            best, top, share = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
        over = excess(-top, sums[:, -1], usual[best] if names else 0.0)
        return {
            "lang_pred": [names[b] if k else "und" for b, k in zip(best, known)],
            "score": np.where(known, share, 0.0), "cross_entropy": np.where(known, -top, 0.0),
            "chars": sums[:, -1].astype(np.int64),
            "rejected": [not k or bool(e > limits[b]) for k, e, b in zip(known, over, best)],
        }

    return judge


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``model`` does not reject."""
    judge = _judge(docs, model)
    return keep_rows(docs, [text], lambda b: [not r for r in judge(b.column(0).to_pylist())["rejected"]])


def scored(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", lang: str | None = None
) -> DataFrame:
    """``doc_id, label, lang_pred, score, cross_entropy, chars, rejected`` of every document.

    The language with the lowest cross-entropy per character wins; ties go to the first by
    name. ``score`` is its share when every language's mean log-probability, times ten, is
    normalised. A cross-entropy whose ``excess`` is beyond the language's calibrated limit makes
    the document ``rejected``. A text that
    is null or has no letter gets ``und``, score 0, and is rejected. ``label`` copies ``lang``
    for calibration and plays no part.
    """
    judge = _judge(docs, model)

    def run(batches):
        for batch in batches:
            found = judge(batch.column(1).to_pylist())
            yield {"doc_id": batch.column(0), "label": batch.column(2), **found}

    label = F.lit(None).cast("string") if lang is None else F.col(lang).cast("string")
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), label.alias("label")
    )
    schema = (
        "doc_id long, label string, lang_pred string, score double, cross_entropy double, "
        "chars long, rejected boolean"
    )
    return map_batches(source, run, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cross_entropy, rejected`` of every document.

    Fits on the labelled documents of ``docs`` and scores all of them, whole texts. Without a
    labelled document every text is ``und`` and rejected. Repeated rows are scored alike, a
    null id is never learned from nor held out, and other columns are not read.
    """
    result = scored(docs, fitted(docs, doc_id, text, lang), doc_id, text)
    held = id_remainder(F.col("doc_id"), 4) == 2
    return result.select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )
