"""Quality rules whose cutoffs keep a proven limit on false rejections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import written

#: Fixed values of the contract: white space, symbols and the base rule.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What each measure is divided by; the quotient is the rule's severity.
CEILINGS = {"symbols": 100, "repeats": 50, "dup_lines": 100, "capitals": 100, "calls": 100}
#: Severities tried as cutoffs, laxest first.
GRID = tuple(round(1 - step / 40, 3) for step in range(40))
#: Upper word counts of the strata.
STRATA = (100, 200, 400, 1000)


def _without(text: Column, letters: str) -> Column:
    """Characters of ``text`` that are among ``letters``."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts over every whole text, with built-in functions only.

    A null text counts as empty. Windows of three words are compared by 64-bit hashes inside
    the row, so no text is exploded or shuffled. Only the two named columns are read.
    """
    base = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")
    )
    words = base.withColumn("w", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    hashed = words.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        (F.length("t") - _without(F.col("t"), SPACE)).cast("long").alias("word_chars"),
        _without(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _without(F.col("t"), CAPITALS).cast("long").alias("n_capitals"),
        _without(F.col("t"), "!?").cast("long").alias("n_calls"),
        F.md5(F.col("t").cast("binary")).alias("text_md5"),
        lines.alias("lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    window = F.when(
        F.col("n_words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("h") - 3),
            lambda i: F.struct(
                F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)).alias("k"),
                i.alias("i"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<k:bigint,i:int>>"))
    sorted_windows = hashed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_capitals", "n_calls",
        "text_md5",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(window).alias("s"),
    )
    same = lambda e, j: F.coalesce(F.get("s", j)["k"] == e["k"], F.lit(False))
    repeated = sorted_windows.withColumn(
        "p",
        F.sort_array(
            F.transform(
                F.filter("s", lambda e, j: same(e, j - 1) | same(e, j + 1)), lambda e: e["i"]
            )
        ),
    )
    # Positions covered by the windows: the gap to the next start, three at most.
    gaps = F.zip_with(
        "p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)
    return repeated.withColumn("n_repeat_words", covered).drop("s", "p")


def base_failed() -> Column:
    """Too short, or too many words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def severities() -> dict[str, Column]:
    """Severity by rule; high values are suspect."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    percent = {
        "symbols": 100 * F.col("n_symbols") / words,
        "repeats": 100 * F.col("n_repeat_words") / words,
        "dup_lines": 100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "capitals": 100 * F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "calls": 100 * F.col("n_calls") / words,
    }
    return {name: value / CEILINGS[name] for name, value in percent.items()}


def stratum() -> Column:
    """The band of word counts that a document belongs to."""
    band = F.lit(len(STRATA))
    for number, limit in reversed(list(enumerate(STRATA))):
        band = F.when(F.col("n_words") < limit, number).otherwise(band)
    return band.cast("int")


def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z >= 1: Stirling's series, eight steps up."""
    s = z + 8
    series = (
        (s - 0.5) * F.ln(s) - s + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * s) - 1 / (360 * F.pow(s, 3)) + 1 / (1260 * F.pow(s, 5))
    )
    for step in range(8):
        series = series - F.ln(z + step)
    return series


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exactly summed from k downwards; 1 where k >= n * p."""
    peak = (
        log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    odds = (1 - p) / p
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(state, j):
        term = state["term"] * (k - j + 1) / (n - k + j) * odds
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    total = F.aggregate(steps, start, step, lambda state: state["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(peak) * total)


def distinct_documents(rows: DataFrame) -> DataFrame:
    """One row of ``features`` per id and per text, since copies are no further evidence.

    Of an id with several texts the one with the least checksum stands, of a text under
    several ids the least id; neither choice depends on what the rules measure.
    """
    def least(key: str, by: str) -> DataFrame:
        names = [c for c in kept.columns if c != key]
        return kept.groupBy(key).agg(F.min_by(F.struct(*names), by).alias("x")).select(key, "x.*")

    kept = rows
    kept = least("doc_id", "text_md5")
    return least("text_md5", "doc_id")


def certified_cutoffs(good: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """``stratum, cutoff, n, k``: the lowest severity of each stratum that is proven safe.

    ``good`` are the features of documents labelled good that pass the base rule; repeated rows
    count once, by ``distinct_documents``. A document is
    rejected when any rule's severity is above the cutoff, so the ``k`` rejected among the
    ``n`` good ones of a stratum test all rules together. A cutoff is safe if the exact
    binomial probability of at most ``k`` rejections, were the true share of false rejections
    at ``risk``, is within the level. Cutoffs are tested from the laxest down, a fixed sequence
    whose counts only rise and which ends at the first that is not safe; ``error`` is divided
    among the strata (Bonferroni). So with probability ``1 - error`` no stratum loses more than
    ``risk`` of its good documents. A stratum with too few labels certifies nothing and
    rejects nothing. One row per stratum is all that is gathered.
    """
    level = error / (len(STRATA) + 1)
    worst = F.greatest(*severities().values())
    counts = distinct_documents(good).groupBy(stratum().alias("stratum")).agg(
        F.count("*").alias("n"),
        F.array(*(F.sum((worst > cutoff).cast("long")) for cutoff in GRID)).alias("ks"),
    )
    tried = counts.select("stratum", "n", F.posexplode("ks").alias("step", "k")).withColumn(
        "cutoff", F.get(F.array(*map(F.lit, GRID)), F.col("step"))
    )
    safe = tried.filter(binomial_at_most(F.col("k"), F.col("n"), risk) <= level)
    return safe.groupBy("stratum").agg(
        F.min("cutoff").alias("cutoff"), F.max("n").alias("n"), F.min_by("k", "cutoff").alias("k")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    risk: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """Features, base rule and verdict of every document.

    ``labels`` has ``doc_id, quality``; a document with several labels counts as good only if
    all are 1, and null labels or ids count as none. ``failed`` lists the certified rules that
    a document broke. Null and empty texts have no words and fail the base rule. Repeated rows
    are judged alike and certify as one document; an empty table gives no rows.
    """
    found = written(features(docs, doc_id, text), "rule-features")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
    )
    good = found.filter(~base_failed()).join(marks, "doc_id", "left_semi")
    cutoffs = written(certified_cutoffs(good, risk, error), "cutoffs")
    broken = F.filter(
        F.array(
            *(F.when(value > F.col("cutoff"), F.lit(name)) for name, value in severities().items())
        ),
        lambda x: x.isNotNull(),
    )
    return (
        found.withColumn("stratum", stratum())
        .join(F.broadcast(cutoffs.select("stratum", "cutoff")), "stratum", "left")  # a row each
        .withColumn("base_failed", base_failed())
        .withColumn("failed", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .drop("text_md5")
    )
