"""Language-model scores: a causal self-attention model over subword ids, in numpy."""

from __future__ import annotations

import math
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import _Cache
from tallyfold.llm.common import id_remainder, map_batches
from tallyfold.llm.packing import tokenizer
from tallyfold.session import written

WINDOW, STRIDE = 32, 28  # positions of a context window; positions between window starts
WIDTH = 32  # numbers per position
GROUPS, MEMBERS = 32, 32  # output: first a group of classes, then a class of the group
CLASSES = GROUPS * MEMBERS
SINGLES = 960  # classes that are a single subword
CONTEXTS = 128  # classes before a subword that its cluster is chosen by
INPUTS = 2048  # subwords with an embedding of their own
SHARE = 1.0  # of the training texts, whose windows the model is trained on: all
LEAST_TEXTS = 2500  # training texts at least, where a caller asks for a share
SHARD_WINDOWS, MOST_SHARDS = 8000, 1024  # windows of one task in a round; tasks of a round
LEAST_WINDOWS = 40_000  # fewer are gone over several times in a round, at most MOST_PASSES
MOST_PASSES = 16
STEP = 32  # windows of a training step
BATCH = 4096 // WINDOW  # windows scored at a time
REMEMBERED = 20_000  # texts whose scores a task keeps for their copies
WORDS_KEPT = 150_000  # words that a task counts at a time, and of which it keeps the subwords
TOP_WORDS = 500_000  # words whose counts every task holds; the others are joined
ROUNDS = 4
READ_BYTES = "16m"  # of coded texts in one task: there is much to do for each


def text_words(text: str | None) -> list[bytes]:
    """Lower-cased words (A to Z); only ASCII white space separates."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Subwords:
    """Subword ids of words, each with the space before it; remembers a bounded number."""

    def __init__(self, path: str):
        coder = tokenizer(path)
        self.end = max(coder.vocab.special.values())
        encode = lambda word: coder._word(word.decode("utf-8", "surrogatepass"))
        self.of_word = _Cache(encode, WORDS_KEPT)
        self.kind = "<u2" if self.end < 1 << 16 else "<u4"  # of stored ids

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ids of a text: those of its words, then the end id."""
        data = b"".join(map(self.of_word.__getitem__, words))
        return np.append(np.frombuffer(data, "<u4").astype(np.int64), self.end)


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


@dataclass
class Codes:
    """How ids enter and leave the model: input rows, output classes, shares in the class."""

    inputs: np.ndarray
    classes: np.ndarray
    share: np.ndarray  # log-probability of an id within its class


def contexts(counts: np.ndarray) -> np.ndarray:
    """By id, the context that it is to what follows: its rank, the rare ones all one."""
    found = np.full(len(counts), CONTEXTS - 1, np.int64)
    order = np.argsort(-counts, kind="stable")[: CONTEXTS - 1]
    found[order] = np.arange(len(order))
    return found


def coded(counts: np.ndarray, neighbours: np.ndarray) -> Codes:
    """Classes from the counts of all subwords and, for the rarer ones, their neighbours.

    ``neighbours`` counts by id how often it follows each context. The most frequent subwords are
    classes of their own. The others are clustered by what they follow (k-means); those that
    follow nothing known share the last class. Classes with like neighbours form the groups of
    the output. Within a class, ids are drawn by their smoothed counts.
    """
    order = np.argsort(-counts, kind="stable")
    inputs = np.full(len(counts), 0, np.int64)
    classes = np.full(len(counts), CLASSES - 1, np.int64)
    classes[order[:SINGLES]] = np.arange(min(SINGLES, len(order)))
    seen = np.flatnonzero((classes == CLASSES - 1) & (neighbours.sum(axis=1) > 0))
    groups = CLASSES - SINGLES - 1
    if len(seen) >= groups:
        table = neighbours[seen].astype(np.float32)
        weight = table.sum(axis=1)
        table = np.sqrt(table / weight[:, None])
        picks = np.argsort(-weight, kind="stable")[:groups]
        centres = table[picks].copy()
        for _ in range(8):
            nearest = (table @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
            for group in range(groups):
                own = nearest == group
                if own.any():
                    centres[group] = np.average(table[own], axis=0, weights=weight[own])
        classes[seen] = SINGLES + nearest
    table = np.zeros((CLASSES, CONTEXTS))
    np.add.at(table, classes, neighbours)
    table = np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))
    place = np.empty(CLASSES, np.int64)
    place[np.concatenate(_halved(table, np.arange(CLASSES), GROUPS))] = np.arange(CLASSES)
    classes = place[classes]
    inputs[order[: INPUTS - CLASSES]] = CLASSES + np.arange(min(INPUTS - CLASSES, len(order)))
    inputs[order[INPUTS - CLASSES :]] = classes[order[INPUTS - CLASSES :]]
    smooth = counts + 0.1
    share = np.log(smooth / np.bincount(classes, smooth, CLASSES)[classes])
    return Codes(inputs, classes, share)


def _halved(table: np.ndarray, rows: np.ndarray, parts: int) -> list[np.ndarray]:
    """Equal parts of rows that are near each other: halves along the main direction, again."""
    if parts == 1:
        return [rows]
    own = table[rows] - table[rows].mean(axis=0)
    along = own @ np.linalg.svd(own, full_matrices=False)[2][0]
    order = rows[np.argsort(along, kind="stable")]
    half = len(order) // 2
    return _halved(table, order[:half], parts // 2) + _halved(table, order[half:], parts // 2)


def _by_group(groups: np.ndarray):
    """The order that brings equal groups together, and each group's slice of it."""
    order = np.argsort(groups.astype(np.uint8), kind="stable")
    cuts = np.append(0, np.cumsum(np.bincount(groups, minlength=GROUPS)))
    return order, [(g, slice(a, b)) for g, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _own_log(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at one column."""
    ones = np.ones(z.shape[1], z.dtype)
    found = z[np.arange(len(z)), own] - np.log(np.exp(z) @ ones)
    if not np.isfinite(found).all():  # only where numbers are beyond 32 bits
        z = z - z.max(axis=1, keepdims=True)
        found = z[np.arange(len(z)), own] - np.log(np.exp(z) @ ones)
    return found


def _softmax_down(
    z: np.ndarray, own: np.ndarray, real: np.ndarray, out: np.ndarray
) -> tuple[np.ndarray, float]:
    """Gradient by ``z`` of the loss summed over the rows that are ``real`` (1, not 0), and it."""
    ones = np.ones(z.shape[1], z.dtype)
    high = np.exp(z, out=out)
    total = high @ ones
    if not (np.isfinite(total).all() and total.all()):  # only where numbers are beyond 32 bits
        high = np.exp(z - z.max(axis=1, keepdims=True), out=out)
        total = high @ ones
    at = np.arange(len(z)), own
    loss = -float((np.log(high[at] / total + 1e-12) * real).sum())
    high *= (real / total)[:, None]
    high[at] -= real
    return high, loss


class Attention:
    """One causal self-attention layer with a residual, from input rows to output classes."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / math.sqrt(s[0])).astype(np.float32)
        self.parts = {
            "embed": 0.3 * rng.standard_normal((INPUTS, WIDTH)).astype(np.float32),
            "place": 0.05 * rng.standard_normal((WINDOW, WIDTH)).astype(np.float32),
            "query": draw(WIDTH, WIDTH), "key": draw(WIDTH, WIDTH), "value": draw(WIDTH, WIDTH),
            "mix": 0.3 * draw(WIDTH, WIDTH), "out": draw(WIDTH, GROUPS),
            "bias": np.zeros(GROUPS, np.float32),
            "inner": np.stack([draw(WIDTH, MEMBERS) for _ in range(GROUPS)]),
            "inner_bias": np.zeros((GROUPS, MEMBERS), np.float32),
        }
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e4, np.float32), 1)
        self._projected, self._rooms = None, {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Space for a step's numbers, used again: fresh pages cost more than the sums on them."""
        size, kind = math.prod(shape), self.parts["mix"].dtype
        held = self._rooms.get(name)
        if held is None or held.size < size or held.dtype != kind:
            held = self._rooms[name] = np.empty(size, kind)
        return held[:size].reshape(shape)

    def hidden(self, rows: np.ndarray):
        """Vectors of all positions of a batch of windows, and what training needs.

        They hold until the next call.
        """
        p, (count, size) = self.parts, rows.shape
        flat = self._room("x", count * size, WIDTH)
        np.take(p["embed"], rows.ravel(), axis=0, out=flat, mode="clip")
        x = flat.reshape(count, size, WIDTH)
        x += p["place"][:size]
        joint = np.concatenate([p["query"] / np.float32(math.sqrt(WIDTH)), p["key"], p["value"]], axis=1)
        every = np.matmul(flat, joint, out=self._room("qkv", count * size, 3 * WIDTH))
        q, k, v = np.split(every.reshape(count, size, 3 * WIDTH), 3, axis=2)
        a = np.matmul(q, k.transpose(0, 2, 1), out=self._room("a", count, size, size))
        a += self.mask[:size, :size]
        np.exp(a, out=a)
        ones = np.ones((size, 1), a.dtype)
        total = a @ ones
        if not np.isfinite(total).all():  # only where scores are beyond 32-bit numbers
            a = np.exp(np.minimum(q @ k.transpose(0, 2, 1), 60) + self.mask[:size, :size])
            total = a @ ones
        c = np.matmul(a, v, out=self._room("c", count, size, WIDTH))
        c /= total
        h = np.matmul(c.reshape(-1, WIDTH), p["mix"], out=self._room("h", count * size, WIDTH))
        h += flat
        return h.reshape(x.shape), (x, q, k, v, a, total, c)

    def vectors(self, rows: np.ndarray, low: int) -> np.ndarray:
        """What ``hidden`` gives from position ``low`` on, and no more than that needs."""
        p, (count, size) = self.parts, rows.shape
        of_rows, of_places = self.projected()
        every = self._room("every", count, size, 4 * WIDTH)
        np.take(of_rows, rows, axis=0, out=every, mode="clip")
        every += of_places[:size]
        k, v, q, top = np.split(every, 4, axis=2)
        q, keys = q[:, low:], k.transpose(0, 2, 1)
        a = np.matmul(q, keys, out=self._room("a", count, size - low, size))
        a += self.mask[low:size, :size]
        np.exp(a, out=a)
        total = a @ np.ones(size, a.dtype)
        if not np.isfinite(total).all():  # only where scores are beyond 32-bit numbers
            a = np.exp(np.minimum(q @ keys + self.mask[low:size, :size], 60))
            total = a @ np.ones(size, a.dtype)
        c = np.matmul(a, v, out=self._room("c", count, size - low, WIDTH))
        c /= total[:, :, None]
        h = np.matmul(c.reshape(-1, WIDTH), p["mix"], out=self._room("h", count * (size - low), WIDTH))
        h = h.reshape(c.shape)
        h += top[:, low:]
        return h

    def projected(self) -> tuple[np.ndarray, np.ndarray]:
        """Key, value, query and the vector itself of every input row, and of every place.

        Made once for a model that is not trained any more.
        """
        if self._projected is None:
            p = self.parts
            query = p["query"] / np.float32(math.sqrt(WIDTH))
            joint = np.concatenate([p["key"], p["value"], query], axis=1)
            self._projected = tuple(
                np.concatenate([p[n] @ joint, p[n]], axis=1) for n in ("embed", "place")
            )
        return self._projected

    def class_logs(self, hidden: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log-probability of the given class at each position: its group's, and in the group."""
        p, (groups, members) = self.parts, np.divmod(classes, MEMBERS)
        order, slices = _by_group(groups)
        flat, inner = hidden.take(order, axis=0), np.empty((len(hidden), MEMBERS), hidden.dtype)
        for g, part in slices:
            np.matmul(flat[part], p["inner"][g], out=inner[part])
        inner += p["inner_bias"].take(groups[order], axis=0)
        found = np.empty(len(hidden), hidden.dtype)
        found[order] = _own_log(inner, members[order])
        return found + _own_log(hidden @ p["out"] + p["bias"], groups)

    def gradients(self, rows: np.ndarray, classes: np.ndarray, real: np.ndarray | None = None):
        """Mean loss over the ``real`` positions of windows (all, without a mask), and its slopes."""
        real = (np.ones(rows.shape) if real is None else real).ravel().astype(self.parts["mix"].dtype)
        p, (h, (x, q, k, v, a, total, c)) = self.parts, self.hidden(rows)
        a /= total
        flat, (groups, members) = h.reshape(-1, WIDTH), np.divmod(classes.ravel(), MEMBERS)
        known = max(1.0, float(real.sum()))
        real /= known
        z = np.matmul(flat, p["out"], out=self._room("z", len(flat), GROUPS))
        z += p["bias"]
        outer, loss = _softmax_down(z, groups, real, self._room("outer", *z.shape))
        down = np.matmul(outer, p["out"].T, out=self._room("down", len(flat), WIDTH))
        inner, inner_bias = np.zeros_like(p["inner"]), np.zeros_like(p["inner_bias"])
        order, slices = _by_group(groups)
        sorted_ = np.take(flat, order, axis=0, out=self._room("sorted", *flat.shape), mode="clip")
        z = self._room("z", len(flat), MEMBERS)
        for g, part in slices:
            np.matmul(sorted_[part], p["inner"][g], out=z[part])
        z += p["inner_bias"].take(groups[order], axis=0)
        z, more = _softmax_down(z, members[order], real[order], self._room("z_down", *z.shape))
        loss += more
        back = self._room("back", *flat.shape)
        for g, part in slices:
            np.matmul(sorted_[part].T, z[part], out=inner[g])
            np.matmul(z[part], p["inner"][g].T, out=back[part])
        firsts = [part.start for _, part in slices]
        inner_bias[[g for g, _ in slices]] = np.add.reduceat(z, firsts, axis=0)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        down += np.take(back, place, axis=0, out=sorted_, mode="clip")
        c_down = np.matmul(down, p["mix"].T, out=back).reshape(c.shape)
        a_down = np.matmul(c_down, v.transpose(0, 2, 1), out=self._room("a_down", *a.shape))
        s = np.multiply(a_down, a, out=self._room("s", *a.shape))
        a_down -= s @ np.ones((a.shape[2], 1), a.dtype)
        np.multiply(a, a_down, out=s)
        joint_down = self._room("joint", *x.shape[:2], 3 * WIDTH)
        q_down, k_down, v_down = np.split(joint_down, 3, axis=2)
        np.matmul(s, k, out=q_down)
        np.matmul(s.transpose(0, 2, 1), q, out=k_down)
        np.matmul(a.transpose(0, 2, 1), c_down, out=v_down)
        scale = down.dtype.type(1 / math.sqrt(WIDTH))
        wide = lambda t: t.reshape(-1, t.shape[-1])
        joint = np.concatenate([p["query"] * scale, p["key"], p["value"]], axis=1)
        x_down = np.matmul(wide(joint_down), joint.T, out=sorted_)
        x_down += down
        query, key, value = np.split(wide(x).T @ wide(joint_down), 3, axis=1)
        order = np.argsort(rows.ravel().astype(np.uint16), kind="stable")
        met = rows.ravel()[order]
        first = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
        embed = np.zeros_like(p["embed"])
        by_row = np.take(x_down, order, axis=0, out=self._room("back", *x_down.shape), mode="clip")
        embed[met[first]] = np.add.reduceat(by_row, first, axis=0)
        return loss, {
            "embed": embed, "place": x_down.reshape(h.shape).sum(axis=0),
            "query": query * scale, "key": key, "value": value, "mix": wide(c).T @ down,
            "out": flat.T @ outer, "bias": outer.sum(axis=0), "inner": inner,
            "inner_bias": inner_bias,
        }

    def learn(self, batches, done) -> tuple[float, int]:
        """Adam over ``batches`` of (rows, classes, real); summed loss and windows.

        ``done`` tells from the windows seen so far what part of all training lies behind.
        """
        first = {n: np.zeros_like(w) for n, w in self.parts.items()}
        second = {n: np.zeros_like(w) for n, w in self.parts.items()}
        total, seen = 0.0, 0
        for step, (rows, classes, real) in enumerate(batches, 1):
            loss, down = self.gradients(rows, classes, real)
            rate = 0.01 * min(1, step / 20) * (1 - 0.9 * min(1, done(seen)))
            total, seen = total + loss * len(rows), seen + len(rows)
            for name, g in down.items():
                g = g.astype(first[name].dtype, copy=False)
                first[name] *= 0.9
                first[name] += 0.1 * g
                g *= g
                g *= 0.01
                second[name] *= 0.99
                second[name] += g
                np.divide(second[name], 1 - 0.99**step, out=g)
                size = np.sqrt(g, out=g)
                size += 1e-8
                move = np.divide(first[name], size, out=size)
                move *= rate / (1 - 0.9**step)
                self.parts[name] -= move
        return total, seen

    def flat(self) -> np.ndarray:
        """All weights in one row."""
        return np.concatenate([w.ravel() for w in self.parts.values()])

    def filled(self, flat: np.ndarray) -> Attention:
        """This model with the weights of a row that ``flat`` made."""
        at = 0
        for name, w in self.parts.items():
            self.parts[name] = flat[at : at + w.size].reshape(w.shape).astype(w.dtype)
            at += w.size
        return self


class Scorer:
    """Log10 probabilities of whole texts: overlapping windows, each id scored once."""

    def __init__(self, codes: Codes, model: Attention, end: int):
        self.codes, self.model, self.end = codes, model, end

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Per text, given as ids: the sum over its ids; every text ends with the end id.

        The first window scores all its positions, later ones only those that no window before
        them scored, so each has at least ``WINDOW - STRIDE`` positions before it.
        """
        sizes = np.array([len(t) for t in texts])
        ids = np.concatenate(texts)
        starts = np.cumsum(sizes) - sizes
        back = np.roll(ids, 1)
        back[starts] = self.end  # a text begins after an end
        rows = np.append(self.codes.inputs[back], np.zeros(WINDOW, np.int64))
        classes = np.append(self.codes.classes[ids], np.zeros(WINDOW, np.int64))
        inner = np.add.reduceat(self.codes.share[ids], starts)
        counts = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
        owner = np.repeat(np.arange(len(texts)), counts)
        number = 1 + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        every = np.arange(len(texts))
        return (
            self._windows(rows, classes, every, starts, sizes, 0)
            + self._windows(
                rows, classes, owner, starts[owner] + number * STRIDE,
                sizes[owner] - number * STRIDE, WINDOW - STRIDE, len(texts),
            )
            + inner
        ) / math.log(10)

    def _windows(self, rows, classes, owner, begin, left, low, texts=0) -> np.ndarray:
        """Sums by text of the scores from position ``low`` on of windows at ``begin``.

        ``left`` is how many ids of the text there are from the window's start.
        """
        total = np.zeros(texts or len(owner))
        place = np.arange(WINDOW)
        for at in range(0, len(owner), BATCH):
            part = slice(at, at + BATCH)
            index = begin[part, None] + place
            logs = self.model.class_logs(
                self.model.vectors(rows[index], low).reshape(-1, WIDTH), classes[index[:, low:]].ravel()
            ).reshape(-1, WINDOW - low)
            logs[place[low:] >= left[part, None]] = 0
            np.add.at(total, owner[part], logs.sum(axis=1, dtype=np.float64))
        return total


def word_counts(training: DataFrame) -> DataFrame:
    """``word, n`` over every text of ``training`` (``text``); ends are not included.

    Tasks count their own words first, in parts of bounded size.
    """

    def run(batches):
        counts: Counter = Counter()

        def flushed():
            items = list(counts.items())
            counts.clear()
            for at in range(0, len(items), 50_000):
                part = items[at : at + 50_000]
                words = [w.decode("utf-8", "replace") for w, _ in part]
                yield {"word": words, "n": [n for _, n in part]}

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text_words(text))
                if len(counts) > WORDS_KEPT:
                    yield from flushed()
        yield from flushed()

    rows = map_batches(training.select("text"), run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def subword_counts(words: DataFrame, path: str, size: int) -> np.ndarray:
    """Counts of all subword ids, from the counts of all words."""

    def run(batches):
        coder, counts = subwords(path), np.zeros(size, np.int64)
        for batch in batches:
            parts, times = [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.append(coder.of_word.encode(word.encode("utf-8", "surrogatepass")))
                times.append(n)
            sizes = [len(p) // 4 for p in parts]
            every = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
            np.add.at(counts, every, np.repeat(np.array(times, np.int64), sizes))
        used = np.flatnonzero(counts)
        yield {"id": used, "n": counts[used]}

    return _summed(map_batches(words.select("word", "n"), run, "id int, n long"), size)


def training_windows(training: DataFrame, docs: int, path: str, share: float, least: int) -> DataFrame:
    """``ids, real``: windows of one id more than ``WINDOW``, of all texts or a hashed share.

    All ids of a text are targets once, its end included; a text's last window is filled up
    with ends, and ``real`` says how many of its targets are the text's. Below a ``share`` of 1
    only as many of the texts are chosen, ``least`` of them at least. Texts that ``coded_texts``
    coded (``ids``) are not coded again.
    """
    share = min(1.0, max(share, least / max(1, docs)))
    if share < 1:
        draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
        training = training.filter(draw < share)
    column = "ids" if "ids" in training.columns else "text"

    def run(batches):
        coder = subwords(path)
        for batch in batches:
            values = batch.column(0).to_pylist()
            for at in range(0, len(values), 32):
                part = values[at : at + 32]
                if column == "ids":
                    texts = [np.frombuffer(v, coder.kind) for v in part]
                else:
                    texts = [coder.ids(text_words(v)) for v in part]
                sizes = np.array([len(t) for t in texts])
                counts = -(-sizes // WINDOW)
                ends = np.cumsum(counts)
                # An end before each text's ids, and ends after them up to whole windows.
                full = np.full(ends[-1] * WINDOW + 1, coder.end, np.int32)
                for ids, start in zip(texts, (ends - counts) * WINDOW + 1):
                    full[start : start + len(ids)] = ids
                rows = np.lib.stride_tricks.sliding_window_view(full, WINDOW + 1)[::WINDOW].copy()
                number = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
                rows[number == 0, 0] = coder.end
                real = np.minimum(WINDOW, np.repeat(sizes, counts) - number * WINDOW).astype(np.int32)
                for low in range(0, len(rows), 10_000):
                    some = rows[low : low + 10_000]
                    cuts = np.arange(0, some.size + 1, WINDOW + 1, np.int32)
                    flat = pa.array(some.reshape(-1))
                    yield {"ids": pa.ListArray.from_arrays(cuts, flat), "real": real[low : low + 10_000]}

    return map_batches(training.select(column), run, "ids array<int>, real int")


def _arrays(batch) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their numbers of real targets, from an Arrow batch."""
    ids = batch.column(0).flatten().to_numpy().astype(np.int64).reshape(-1, WINDOW + 1)
    return ids, batch.column(1).to_numpy()


def target_counts(windows: DataFrame, size: int) -> np.ndarray:
    """Counts of all ids, ends included, as targets of ``windows``."""

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            ids, real = _arrays(batch)
            counts += np.bincount(ids[:, 1:][np.arange(WINDOW) < real[:, None]], minlength=size)
        used = np.flatnonzero(counts)
        yield {"id": used, "n": counts[used]}

    return _summed(map_batches(windows.select("ids", "real"), run, "id int, n long"), size)


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sums of ``n`` by ``id``."""
    found = np.zeros(size, np.int64)
    for row in rows.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most ``size``
        found[row.id] = row.n
    return found


def neighbour_counts(windows: DataFrame, words: DataFrame, counts: np.ndarray, path: str) -> np.ndarray:
    """By id and context before it, how often they meet.

    Taken from the training windows; for ids that these lack, from inside the words of all
    training texts. At most one number per id and context reaches the driver.
    """
    context = contexts(counts)
    found = np.zeros((len(counts), CONTEXTS), np.float32)

    def pairs(frame: DataFrame, function) -> None:
        def run(batches):
            table = np.zeros(len(counts) * CONTEXTS, np.float32)
            for batch in batches:
                before, after, n = function(batch)
                np.add.at(table, after * CONTEXTS + context[before], np.asarray(n, np.float32))
            used = np.flatnonzero(table)
            for at in range(0, len(used), 50_000):
                part = used[at : at + 50_000]
                yield {"cell": part, "n": table[part]}

        sums = map_batches(frame, run, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n"))
        rows = sums.toArrow()
        found.reshape(-1)[rows["cell"].to_numpy()] = rows["n"].to_numpy()

    def of_windows(batch):
        ids, real = _arrays(batch)
        return ids[:, :-1].ravel(), ids[:, 1:].ravel(), (np.arange(WINDOW) < real[:, None]).ravel()

    pairs(windows, of_windows)
    lacking = found.sum(axis=1) == 0
    if not (lacking & (counts > 0)).any():  # as when the windows are of all texts
        return found

    def of_words(batch):
        coder = subwords(path)
        parts = [
            np.frombuffer(coder.of_word.encode(w.encode("utf-8", "surrogatepass")), "<u4")
            for w in batch.column(0).to_pylist()
        ]
        sizes = np.array([len(p) for p in parts])
        every = np.concatenate([*parts, [0]]).astype(np.int64)[:-1]
        inner = np.ones(len(every), bool)
        inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False  # what is before these is not known
        at = np.flatnonzero(inner & lacking[every])
        times = np.repeat(batch.column(1).to_numpy(), sizes)
        return every[at - 1], every[at], times[at]

    pairs(words.select("word", "n"), of_words)
    return found


def schedule(count: int, rounds: int) -> list[tuple[list[int], int]]:
    """Per round, which of ``rounds`` slots of ``count`` windows it goes over, and how often.

    Every slot is gone over equally often, once at least; few windows are gone over again until
    a round has about ``LEAST_WINDOWS``, at most ``MOST_PASSES`` times.
    """
    every = min(rounds * MOST_PASSES, max(1, rounds * LEAST_WINDOWS // max(1, count)))
    if every >= rounds:
        return [(list(range(rounds)), every // rounds)] * rounds
    return [([(turn * every + n) % rounds for n in range(every)], 1) for turn in range(rounds)]


def trained(windows: DataFrame, codes: Codes, count: int, rounds: int, seed: int = 0) -> Attention:
    """A model trained on all ``count`` windows: each round's tasks start from one model.

    Windows are dealt over tasks and over slots, and ``schedule`` says which slots a round goes
    over. A task goes over its windows with Adam, holding ``SHARD_WINDOWS`` at a time; the models
    of a round are averaged by their windows. Only the averages, as many numbers as the model
    has, reach the driver. Tasks get more windows each once there are ``MOST_SHARDS``.
    """
    spark, model = windows.sparkSession, Attention(seed)
    plan = schedule(count, rounds) if count else []
    in_round = count * len(plan[0][0]) // rounds if plan else 0
    shards = min(MOST_SHARDS, max(1, -(-in_round // SHARD_WINDOWS)))
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(rounds)).cast("int")
    dealt = windows.select("ids", "real").repartition(shards).withColumn("slot", slot)
    dealt = written(dealt, "dealt-windows")
    tasks = dealt.rdd.getNumPartitions()  # small files are read together
    for turn, (slots, passes) in enumerate(plan):
        shared = spark.sparkContext.broadcast((codes, model.flat()))
        own_part = dealt.filter(F.col("slot").isin(slots)).select("ids", "real")
        expected = count * passes * len(slots) / rounds / max(1, tasks)  # windows of a task

        def run(batches, turn=turn, shared=shared, passes=passes, expected=expected):
            codes, flat = shared.value
            own = Attention(seed).filled(flat)
            rng = np.random.default_rng([seed, turn, TaskContext.get().partitionId()])

            def steps(held):
                ids, real = (np.concatenate(x) for x in zip(*held))
                for _ in range(passes):
                    for at in np.array_split(rng.permutation(len(ids)), -(-len(ids) // STEP)):
                        mask = np.arange(WINDOW) < real[at, None]
                        yield codes.inputs[ids[at, :-1]], codes.classes[ids[at, 1:]], mask

            def parts():
                held = []
                for batch in batches:
                    held.append(_arrays(batch))
                    if sum(len(real) for _, real in held) >= SHARD_WINDOWS:
                        yield from steps(held)
                        held = []
                if sum(len(real) for _, real in held):
                    yield from steps(held)

            _, seen = own.learn(parts(), lambda n: (turn + min(1, n / expected)) / rounds)
            if seen:
                weights = own.flat().astype(np.float64) * seen
                yield {"place": np.arange(-1, len(weights)), "total": np.append([seen], weights)}

        sums = map_batches(own_part, run, "place int, total double").groupBy("place")
        rows = sums.agg(F.sum("total").alias("total")).orderBy("place").toArrow()["total"].to_numpy()
        model = model.filled(rows[1:] / rows[0])
        shared.unpersist()
    return model


def coded_texts(source: DataFrame, path: str, top, end_log: float, end_known: int) -> DataFrame:
    """Every text's subword ids and its base sums, so that texts are split and coded once.

    Rows of ``kind`` 0: ``row``, which names the text, ``doc_id, n, known, log`` and ``ids`` (the
    bytes of ``Subwords.kind``) over its words that ``top`` (a broadcast) holds and its end. Rows
    of ``kind`` 1: ``row, word, n`` of the other words.
    """

    def run(batches):
        coder, logs_of = subwords(path), top.value
        base, number = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 32):
                firsts, rest = [], []
                for doc, text in zip(docs[at : at + 32], texts[at : at + 32]):
                    own = text_words(text)
                    logs = list(map(logs_of.get, own))
                    if None in logs:
                        rare = Counter(w for w, x in zip(own, logs) if x is None)
                        rest += [(base + number, w.decode("utf-8", "replace"), n) for w, n in rare.items()]
                        logs = [x for x in logs if x is not None]
                    ids = coder.ids(own).astype(coder.kind).tobytes()
                    firsts.append((base + number, doc, len(own) + 1, len(logs) + end_known, sum(logs) + end_log, ids))
                    number += 1
                names, nothing = ("row", "doc_id", "n", "known", "log", "ids"), [None] * len(firsts)
                yield {"kind": [0] * len(firsts), "word": nothing, **dict(zip(names, zip(*firsts)))}
                for low in range(0, len(rest), 50_000):
                    part = rest[low : low + 50_000]
                    nothing = [None] * len(part)
                    row, word, n = zip(*part)
                    yield {
                        "kind": [1] * len(part), "row": row, "doc_id": nothing, "n": n,
                        "known": nothing, "log": nothing, "word": word, "ids": nothing,
                    }

    schema = "kind int, row long, doc_id long, n long, known long, log double, word string, ids binary"
    return map_batches(source.select("doc_id", "text"), run, schema)


@contextmanager
def small_reads(spark):
    """Tables that actions in this block read are cut into tasks of ``READ_BYTES``."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, READ_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scored(texts: DataFrame, codes: Codes, model: Attention, path: str) -> DataFrame:
    """``score`` instead of ``ids`` for texts that ``coded_texts`` coded; copies once a task."""
    shared = texts.sparkSession.sparkContext.broadcast((codes, model))
    kept = ["row", "doc_id", "n", "known", "log"]

    def run(batches):
        coder = subwords(path)
        scorer = Scorer(*shared.value, coder.end)
        known: dict[bytes, float] = {}
        for batch in batches:
            texts, scores = batch.column(len(kept)).to_pylist(), []
            for at in range(0, len(texts), 32):
                part = texts[at : at + 32]
                keys = [md5(t).digest() for t in part]
                fresh = {k: t for k, t in zip(keys, part) if k not in known}
                made = {}
                if fresh:
                    ids = [np.frombuffer(t, coder.kind).astype(np.int64) for t in fresh.values()]
                    made = dict(zip(fresh, scorer.scores(ids).tolist()))
                scores += [made[k] if k in made else known[k] for k in keys]
                if len(known) > REMEMBERED:
                    known.clear()
                known.update(made)
            yield {**{n: batch.column(at) for at, n in enumerate(kept)}, "score": scores}

    schema = "row long, doc_id long, n long, known long, log double, score double"
    return map_batches(texts.select(*kept, "ids"), run, schema)


def score(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    share: float = SHARE,
    least_texts: int = LEAST_TEXTS,
    top_words: int = TOP_WORDS,
) -> DataFrame:
    """Base score and model score of every whole text.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Learns from
    texts whose crc32 of the id as text modulo 5 is not 1: word and subword counts, classes and
    the attention model from all of them, the model in tasks whose weights are averaged. A
    ``share`` below 1 trains it on that share of the texts (``least_texts`` at least) and takes
    neighbours of subwords that these lack from all words. A null text is empty: its only
    token is the end. A null id counts as a training row. The counts of the most frequent
    words, at most ``top_words``, go to every task; all other words are joined. With nothing to
    learn from, counts are zero and the model is untrained. Repeated rows are scored alike, up
    to the rounding of 32-bit sums; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    training = source.filter(id_remainder(F.col("doc_id"), 5) != 1)
    words = written(word_counts(training), "words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    trained_docs = training.count()
    n_all, kinds = sums.n + trained_docs, sums.v + (trained_docs > 0)
    divisor = math.log10(n_all + 0.5 * (kinds + 1))

    bands = words.groupBy(F.floor(F.log2("n")).cast("int").alias("band")).count().collect()
    left, least = 0, 62
    for row in sorted(bands, key=lambda r: -r.band):
        if left + row["count"] > top_words:
            break
        left, least = left + row["count"], row.band
    frequent = words.filter(F.col("n") >= F.lit(1 << least)).toArrow()
    top = {
        w.encode("utf-8", "surrogatepass"): math.log10(n + 0.5)
        for w, n in zip(frequent["word"].to_pylist(), frequent["n"].to_pylist())
    }
    size = subwords(path).end + 1
    shared = spark.sparkContext.broadcast(top)  # at most ``top_words``
    end_log, end_known = math.log10(trained_docs + 0.5), int(trained_docs > 0)
    rows = written(
        coded_texts(source, path, shared, end_log, end_known), "coded-texts", compression="zstd"
    )
    texts = rows.filter("kind = 0")
    with small_reads(spark):
        if share >= 1:
            learned = texts.filter(id_remainder(F.col("doc_id"), 5) != 1)
            windows = training_windows(learned, trained_docs, path, share, least_texts)
            width = np.dtype(subwords(path).kind).itemsize * WINDOW
            count = learned.agg(F.sum(F.ceil(F.octet_length("ids") / width))).first()[0] or 0
            counts = target_counts(windows, size)
        else:
            windows = training_windows(training, trained_docs, path, share, least_texts)
            windows = written(windows, "windows")
            count = windows.count()
            counts = subword_counts(words, path, size)
            counts[size - 1] += trained_docs
        codes = coded(counts, neighbour_counts(windows, words, counts, path))
    model = trained(windows, codes, count, ROUNDS)
    with small_reads(spark):
        scores = written(scored(texts, codes, model, path), "scores")
    rare = (
        rows.filter("kind = 1").select("row", "word", "n")
        .join(words.select("word", F.col("n").alias("c")), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rest"),
        )
    )
    total = F.col("log") + F.coalesce("rest", F.lit(0.0)) - F.col("n") * divisor
    return scores.join(rare, "row", "left").select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 1).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        total.alias("base_score"),
        "score",
    )
