"""Exact removal of byte strings of a given length that start at more than one place.

Every string of ``length`` bytes contains the gram of smallest hash, its anchor, at the same place
wherever the string occurs. So equal strings have equal anchors: Spark counts anchors over all
texts, and only passages around anchors that several places share are compared. Equal passages
are found by their hash; passages that share an anchor and differ are sorted as suffix arrays
(``suffixes``), a bounded number per task. An anchor with more distinct passages than that is
split by the bytes that ever smaller blocks of its strings have in common.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import map_batches
from tallyfold.llm.suffixes import repeated_heads
from tallyfold.session import written

LENGTH = 400
#: Bytes that are hashed at a time, and the longest piece of a text that is.
CHUNK = 1 << 18
#: Distinct passages of one anchor that one suffix array takes; more are split first.
MOST_PASSAGES = 2000
#: Bytes of passages in one suffix array, on average.
ARRAY_BYTES = 1 << 21

TEXT = ["t1", "t2"]
ITEMS = "t1 long, t2 long, h long, d long, s long, e long, a long"
PASSAGES = (
    "t1 long, t2 long, s long, own boolean, h long, d long, lead long, low long, high long, "
    "passage binary"
)
SPANS = "t1 long, t2 long, s long, e long"


def gram_of(length: int) -> int:
    return max(length * 8 // 25, 1)


def hash64(*parts: bytes) -> int:
    value = hashlib.blake2b(digest_size=8)
    for part in parts:
        value.update(part)
    return int.from_bytes(value.digest(), "little", signed=True)


class Anchors:
    """Finds the anchors of all strings in a list of pieces of texts."""

    def __init__(self, length: int):
        self.length, self.gram = length, gram_of(length)
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        size = CHUNK * 2 + length
        self.up = self._powers(base, size)
        self.down = self._powers(inverse, size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def hashes(self, text: np.ndarray) -> np.ndarray:
        """A hash of the gram at every position, from its bytes alone."""
        count = len(text) - self.gram + 1
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.down[: len(text)], out=sums[1:])
        found = (sums[self.gram :] - sums[:count]) * self.up[:count]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(29))

    def find(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        """Anchor hash, first and end string start, and anchor place, of all runs of strings.

        The strings that start in ``[s, e)`` have the anchor at ``a``; no run crosses a piece.
        Equal hashes within a string count leftmost first, which every copy of it shares.
        """
        text = np.frombuffer(b"".join(pieces), np.uint8)
        hashes = self.hashes(text)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        wide, span = self.length - self.gram + 1, 1
        while span * 2 <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if wide > span:
            least = np.minimum(least[: span - wide], least[wide - span :])
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        valid = np.zeros(len(least) + 1, np.int32)
        valid[starts] += 1
        valid[starts + sizes - self.length + 1] -= 1
        places = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        anchors = (least[places] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        firsts = np.flatnonzero(
            np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (np.diff(places) != 1)])
        )
        ends = np.concatenate([firsts[1:], [len(places)]]) - 1
        at = anchors[firsts]
        return hashes[at].view(np.int64), places[firsts], places[ends] + 1, at


def items(texts: DataFrame, length: int) -> DataFrame:
    """``ITEMS``: per text (``t1, t2, bytes``) the runs ``[s, e)`` of strings that share an anchor.

    ``h`` is the anchor's hash, ``a`` its place, ``d`` a hash of the passage that the strings
    cover. A long text is cut into overlapping pieces; a run that a cut divides becomes two.
    """

    def run(batches):
        finder = Anchors(length)
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            pieces, marks, size = [], [], 0
            column = batch.column(2)
            for row in range(batch.num_rows):
                value = column[row].as_py()
                for at in range(0, len(value) - length + 1, CHUNK):
                    piece = value[at : at + CHUNK + length - 1]
                    pieces.append(piece)
                    marks.append((row, at))
                    size += len(piece)
                    if size >= CHUNK:
                        yield columns(finder, pieces, marks, keys)
                        pieces, marks, size = [], [], 0
            if pieces:
                yield columns(finder, pieces, marks, keys)

    def columns(finder, pieces, marks, keys):
        h, s, e, a = finder.find(pieces)
        data = b"".join(pieces)
        reach = length - 1
        d = b"".join(
            hashlib.blake2b(data[i : j + reach], digest_size=8).digest()
            for i, j in zip(s.tolist(), e.tolist())
        )
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        piece = np.searchsorted(starts, s, side="right") - 1
        row = np.array([m[0] for m in marks])[piece]
        shift = np.array([m[1] for m in marks])[piece] - starts[piece]
        return {
            "t1": keys[0][row], "t2": keys[1][row], "h": h, "d": np.frombuffer(d, "<i8"),
            "s": s + shift, "e": e + shift, "a": a + shift,
        }

    return map_batches(texts, run, ITEMS)


def counted(rows: DataFrame, weight) -> DataFrame:
    """Per (h, d): ``n`` places, and per h ``kinds`` of passages and ``singles`` among them.

    Written before it is joined: only between two plain shuffles does Spark split a hot key.
    """
    kinds = rows.groupBy("h", "d").agg(F.sum(weight).alias("n"))
    kinds = written(kinds, "kinds")
    anchors = kinds.groupBy("h").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.sum((F.col("n") == 1).cast("long")).alias("singles"),
    )
    return kinds.join(written(anchors, "anchors"), "h").filter("kinds > 1 OR n > 1")


def searched(passages: DataFrame, length: int) -> DataFrame:
    """``SPANS`` of the strings of own passages that occur again, by suffix arrays."""
    size = passages.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    arrays = size // ARRAY_BYTES + 1
    placed = passages.withColumn("array", F.pmod(F.xxhash64("h"), F.lit(arrays)).cast("int"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # A repeated row would look like a second place of its passage.
        frame = frame.drop_duplicates(["h", "d"])
        hits = repeated_heads(frame["passage"].tolist(), length)
        found = []
        for t1, t2, s, own, hit in zip(frame.t1, frame.t2, frame.s, frame.own, hits):
            if own and len(hit):
                cuts = np.flatnonzero(np.diff(hit) != 1) + 1
                found += [(t1, t2, s + int(p[0]), s + int(p[-1]) + 1) for p in np.split(hit, cuts)]
        return pd.DataFrame(found, columns=[*TEXT, "s", "e"]).astype("int64")

    return placed.groupBy("array").applyInPandas(run, SPANS)


def split_blocks(passages: DataFrame, length: int) -> DataFrame:
    """Every passage's strings in two blocks by their place before the anchor.

    All strings of a block share the bytes from its last start to its first end; their hash
    becomes the new key, so only passages that agree in more than the anchor still meet. A block
    of one string is that string.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                middle = (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle, r["high"])):
                    heads = len(r["passage"]) - length + 1
                    first, end = max(low + r["lead"], 0), min(high + r["lead"], heads)
                    if first >= end:
                        continue
                    shared = r["passage"][high - 1 + r["lead"] : low + r["lead"] + length]
                    part = r["passage"][first : end - 1 + length]
                    key = hash64(shared, b"%d %d %d" % (r["h"], low, high))
                    rows.append(
                        (r["t1"], r["t2"], r["s"] + first, r["own"], key, hash64(part),
                         r["lead"] - first, low, high, part)
                    )
            names = [column.split()[0] for column in PASSAGES.split(", ")]
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    return map_batches(passages, run, PASSAGES)


def repeated(docs: DataFrame, texts: DataFrame, length: int, id_column: str, column: str):
    """Texts to look at (``t1, t2, bytes``), and ``SPANS`` of their strings that occur again.

    ``texts`` has ``t1, t2, copies, first_id`` per distinct text.
    """
    own = docs.select(
        F.col(id_column).alias("id"),
        *_keys(F.col(column)),
        F.col(column).cast("binary").alias("bytes"),
    ).filter(F.octet_length("bytes") >= length)
    whole = written(items(own.select(*TEXT, "bytes"), length), "anchors")
    place = F.xxhash64(*TEXT, "s")
    shared = whole.groupBy("h").agg(F.min(place).alias("a1"), F.max(place).alias("a2"))
    shared = written(shared.filter("a1 <> a2").select("h"), "shared")
    suspects = written(whole.join(shared, "h", "left_semi").distinct(), "suspects")
    known = written(counted(suspects, F.lit(1)), "known")
    suspects = written(suspects.join(known, ["h", "d"]), "suspects")
    spans = [suspects.filter("n > 1").select(*TEXT, "s", "e")]

    # One place of each distinct passage is sent, where some passage of its anchor is single.
    sent = suspects.filter("singles > 0 AND kinds > 1")
    sent = sent.groupBy("h", "d").agg(
        F.min(F.struct(*TEXT, "s", "e", "a", "n", "kinds")).alias("at")
    )
    sent = sent.groupBy("at.t1", "at.t2").agg(
        F.collect_list(F.struct("h", "d", "at.s", "at.e", "at.a", "at.n", "at.kinds")).alias("cut")
    )
    touched = suspects.groupBy(*TEXT).agg(F.lit(1).alias("touched"))
    wanted = touched.join(sent, TEXT, "left").join(texts, TEXT)
    wanted = wanted.select(
        F.col("t1").alias("w1"), F.col("t2").alias("w2"), "first_id", "copies", "cut"
    ).filter("copies = 1 OR cut IS NOT NULL")
    same = (
        (F.col("t1") == F.col("w1")) & (F.col("t2") == F.col("w2"))
        & F.col("id").eqNullSafe(F.col("first_id"))
    )
    # Copies of a text have one entry with the smallest id, so they do not meet in the join.
    looked = written(own.join(written(wanted, "wanted"), same).select(*TEXT, "bytes", "cut"), "texts")

    def cut(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for c in r["cut"]:
                    rows.append(
                        (r["t1"], r["t2"], c["s"], c["n"] == 1, c["h"], c["d"], c["a"] - c["s"],
                         gram_of(length) - length, 1, r["bytes"][c["s"] : c["e"] - 1 + length],
                         c["kinds"])
                    )
            names = [column.split()[0] for column in f"{PASSAGES}, kinds long".split(", ")]
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    passages = looked.filter("cut IS NOT NULL")
    passages = written(map_batches(passages, cut, f"{PASSAGES}, kinds long"), "passages")
    hot = passages.filter(F.col("kinds") > MOST_PASSAGES).drop("kinds")
    spans.append(searched(passages.filter(F.col("kinds") <= MOST_PASSAGES), length))
    while not hot.isEmpty():
        parts = written(split_blocks(hot, length), "blocks")
        # A passage that was found elsewhere stands for two places.
        known = written(counted(parts, F.when(F.col("own"), 1).otherwise(2)), "known")
        parts = written(parts.join(known, ["h", "d"]), "blocks")
        heads = F.octet_length("passage") - length + 1
        spans.append(
            parts.filter("own AND n > 1").select(*TEXT, "s", (F.col("s") + heads).alias("e"))
        )
        parts = parts.filter("singles > 0 AND kinds > 1").dropDuplicates(["h", "d"])
        parts = parts.withColumn("own", F.col("n") == 1)
        few = F.col("kinds") <= MOST_PASSAGES
        names = [name.split()[0] for name in PASSAGES.split(", ")]
        spans.append(searched(written(parts.filter(few).select(*names), "passages"), length))
        hot = written(parts.filter(~few).select(*names), "passages")
    found = spans[0]
    for part in spans[1:]:
        found = found.unionByName(part)
    return looked.select(*TEXT, "bytes"), found


def _keys(text):
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def covered(found: list[dict], length: int, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings starting in the given ranges cover."""
    runs: list[list[int]] = []
    for low, high in sorted((r["s"], r["e"] - 1 + length) for r in found):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return [(low, min(high, size)) for low, high in runs]


def strip(
    docs: DataFrame, id_column: str = "doc_id", column: str = "text", length: int = LENGTH
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept, kept_sha256``: texts without repeated strings.

    A byte goes if a string of ``length`` bytes around it also starts at another place, in this
    text or another; all strings are judged on the input. ``kept`` holds the bytes left, as they
    may end within a character; it is null where nothing was removed. A null text counts as
    empty; texts shorter than ``length`` stay whole; a text that occurs twice goes whole, every
    repeated row included. Ids may be null or repeated. Texts are told apart by 128-bit hashes,
    passages of one anchor by 64-bit ones.
    """
    if length < 8:
        raise ValueError("length is 8 at least")
    text = F.coalesce(F.col(column), F.lit(""))
    narrow = written(
        docs.select(
            F.col(id_column).alias("id"),
            *_keys(text),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.sha2(text.cast("binary"), 256).alias("whole_sha256"),
        ),
        "narrow",
    )
    long = F.col("n_bytes") >= length
    texts = narrow.filter(long).groupBy(*TEXT, "n_bytes").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id")
    )
    texts = written(texts, "distinct-texts")
    looked, spans = repeated(docs, texts.drop("n_bytes"), length, id_column, column)
    spans = spans.groupBy(*TEXT).agg(F.collect_list(F.struct("s", "e")).alias("found"))

    def cut(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                value, at, parts = r["bytes"], 0, []
                runs = covered(r["found"], length, len(value))
                for low, high in runs:
                    parts.append(value[at:low])
                    at = high
                kept = b"".join([*parts, value[at:]])
                removed = len(value) - len(kept)
                sha = hashlib.sha256(kept).hexdigest()
                rows.append((r["t1"], r["t2"], removed, len(runs), kept, sha))
            names = [*TEXT, "n_removed", "n_spans", "kept", "kept_sha256"]
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    schema = "t1 long, t2 long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    single = texts.filter("copies = 1").select(*TEXT)
    edited = map_batches(looked.join(spans.join(single, TEXT), TEXT), cut, schema)
    nothing = F.lit("").cast("binary")
    gone = texts.filter("copies > 1").select(
        *TEXT, F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        nothing.alias("kept"), F.sha2(nothing, 256).alias("kept_sha256"),
    )
    changes = written(edited.unionByName(gone), "changes")
    zero = F.lit(0).cast("long")
    columns = [
        "id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), "kept",
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    ]
    # Short texts have nothing to look up; empty ones would all meet in one task.
    short = narrow.filter(~long).select(
        "*", zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept"),
        F.lit(None).cast("string").alias("kept_sha256"),
    )
    joined = narrow.filter(long).join(changes, TEXT, "left")
    return joined.select(*columns).unionByName(short.select(*columns))
