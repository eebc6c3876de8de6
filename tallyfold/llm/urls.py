"""URL filter: segmented host names scored by multinomial naive Bayes."""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import lower_ascii, map_batches
from tallyfold.session import written

BUCKETS = 1 << 16  # hashed tokens of the model
VOCABULARY = 50_000  # words that the segmenter knows at most
LONGEST = 20  # letters of a word


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits, or null."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def word_counts(texts: DataFrame, column: str, most: int = VOCABULARY) -> dict[str, int]:
    """The words of a text column, by count: at most ``most`` of them.

    Counts cover all rows. The words kept are those at or above a power of two that leaves at
    most ``most``, so what the driver receives is bounded whatever the vocabulary.
    """
    plain = F.lower(F.regexp_replace(column, r"<[^>]*>", " "))
    words = (
        texts.select(F.explode(F.split(plain, r"[^a-z]+")).alias("word"))
        .filter(F.length("word").between(1, LONGEST))
        .groupBy("word")
        .count()
    )
    counted = written(words, "word-counts")
    bands = counted.groupBy(F.floor(F.log2("count")).cast("int").alias("band")).count().collect()
    left, least = 0, 64
    for row in sorted(bands, key=lambda r: -r.band):
        if left + row["count"] > most:
            break
        left, least = left + row["count"], row.band
    kept = counted.filter(F.col("count") >= F.lit(1 << min(least, 62)).cast("long"))
    return {row.word: row["count"] for row in kept.collect()}


class Segmenter:
    """Splits a name into its most likely words (unigram Viterbi)."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        total = sum(counts.values()) + 1
        self.logs = {w: math.log(c / total) for w, c in counts.items()}
        self.unknown = -math.log(total)
        self.split = lru_cache(maxsize=100_000)(self._split)

    def __reduce__(self):
        return Segmenter, (self.counts,)

    def _score(self, word: str) -> float:
        known = self.logs.get(word)
        return known if known is not None else self.unknown - 2.3 * len(word)

    def _split(self, name: str) -> tuple[str, ...]:
        best, start = [0.0], [0]
        for end in range(1, len(name) + 1):
            # Equal scores go to the longest last word.
            score, at = max(
                (best[at] + self._score(name[at:end]), -at)
                for at in range(max(0, end - LONGEST), end)
            )
            best.append(score)
            start.append(-at)
        words, end = [], len(name)
        while end:
            words.append(name[start[end] : end])
            end = start[end]
        return tuple(reversed(words))


def tokens(host: str, path: str, segmenter: Segmenter) -> list[str]:
    """Tokens of a URL: the words of its host, and the parts of its path."""
    found = []
    for part in re.findall(r"[a-z]+|[0-9]+|[^a-z0-9.\-]+", host):
        found += [f"h:{w}" for w in segmenter.split(part)] if part[0].isalpha() else ["h:#"]
    for part in re.findall(r"[^\W\d_]+|\d+", path.lower()):
        found.append("p:#" if part[0].isdigit() else f"p:{part}")
    return found


def buckets(words: list[str]) -> list[int]:
    return [zlib.crc32(w.encode()) % BUCKETS for w in words]


def trained(urls: DataFrame, segmenter, verdicts: tuple[str, str]) -> tuple[np.ndarray, float]:
    """Weights by hashed token and the bias towards the second verdict.

    ``urls`` has ``host, path, verdict``. Tasks add up their own counts, so at most a fixed
    number of buckets per class and task is shuffled, and as many per class reach the driver.
    """

    def run(batches):
        split, counts = segmenter.value, np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                own = counts[int(verdict == verdicts[1])]
                np.add.at(own, buckets(tokens(host, path, split)), 1)
                own[BUCKETS] += 1
        side, bucket = np.nonzero(counts)
        yield {"side": side, "bucket": bucket, "n": counts[side, bucket]}

    source = urls.filter(F.col("verdict").isin(*verdicts)).select("host", "path", "verdict")
    sums = map_batches(source, run, "side int, bucket int, n long")
    counts = np.zeros((2, BUCKETS + 1))
    for row in sums.groupBy("side", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.side, row.bucket] = row.n
    tokens_, rows = counts[:, :BUCKETS], counts[:, BUCKETS]
    seen = tokens_.any(axis=0)
    logs = np.log(tokens_ + 1) - np.log(tokens_.sum(axis=1, keepdims=True) + max(1, seen.sum()))
    bias = math.log(rows[1] + 1) - math.log(rows[0] + 1)
    return np.where(seen, logs[1] - logs[0], 0.0), bias


def judge(
    pages: DataFrame,
    rules: dict[str, str],
    verdicts: tuple[str, str] = ("allow", "block"),
    page_id: str = "page_id",
    url: str = "url",
    content: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, words`` of every URL.

    ``rules`` maps ``host/path`` to one of ``verdicts``; the longest that fits decides. Other
    URLs are scored by naive Bayes, which learns from the URLs that rules decide; the word
    counts of the segmenter come from the pages' own texts. ``score`` is the probability of
    the second verdict; a tie, or no URL to learn from, gives the first. Null and malformed
    URLs have an empty host and path, no tokens, and are scored by the bias alone. Repeated
    rows are judged alike; other columns are not read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    context = spark.sparkContext
    host, path = parsed(F.col(url))
    split = pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    given = F.coalesce(*(F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()))
    ruled = ruled.withColumn("verdict", given)
    segmenter = context.broadcast(Segmenter(word_counts(pages, content)))  # at most VOCABULARY
    weights, bias = trained(ruled, segmenter, verdicts)
    model = context.broadcast(weights.astype(np.float32))

    def run(batches):
        split_, table = segmenter.value, model.value
        for batch in batches:
            page, hosts, paths, rule, verdict = (c.to_pylist() for c in batch.columns)
            words = [tokens(h, p, split_) for h, p in zip(hosts, paths)]
            odds = np.array([bias + float(table[buckets(w)].sum()) for w in words])
            score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield {
                "page_id": page, "host": hosts, "path": paths, "rule": rule,
                "verdict": [v or verdicts[int(o > 0)] for v, o in zip(verdict, odds)],
                "score": score, "words": words,
            }

    schema = (
        "page_id long, host string, path string, rule string, verdict string, score double, "
        "words array<string>"
    )
    return map_batches(ruled, run, schema)
