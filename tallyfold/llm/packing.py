"""Cost-balanced packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import PIECES, Encoder, packed
from tallyfold.llm.common import map_batches

LENGTH = 2048
WINDOW = 1 << 20  # tokens that one task packs at a time


def cost(length, quadratic: float = 1 / 1024):
    """Estimated work of a piece: linear layers plus attention within the piece."""
    return length * (1.0 + quadratic * length)


def capacities(total: int, length: int, last: bool) -> list[int]:
    """Sequences that hold ``total`` tokens without padding.

    Full sequences, and at the end of a task shorter ones whose lengths are powers of two,
    which need no padding either.
    """
    full, rest = divmod(total, length)
    sizes = [length] * full
    if last:
        sizes += [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return sizes


def balanced(lengths: list[int], room: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Place pieces, longest first, each in the cheapest sequence with room for it.

    A piece that fits nowhere whole is cut: its first part fills the cheapest sequence that
    still has room. Yields (piece, start in the piece, length, sequence, offset). Equal lengths
    go in the given order, equal costs to the first sequence. What is left when every sequence
    is full is not placed.
    """
    free = np.asarray(room, np.int64)
    size = free.copy()
    spent = np.zeros(len(room))
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[piece]
        while left:
            fits = free >= left
            fits = fits if fits.any() else free > 0
            if not fits.any():
                return
            best = int(np.where(fits, spent, np.inf).argmin())
            taken = int(min(left, free[best]))
            yield piece, start, taken, best, int(size[best] - free[best])
            free[best] -= taken
            spent[best] += cost(taken)
            start, left = start + taken, left - taken


class _LibraryEncoder(Encoder):
    """The same ids with the public BPE library doing the merges of unseen words."""

    def __init__(self, path: str):
        super().__init__(path)
        special = set(self.vocab.special.values())
        ranks = {b: i for i, b in enumerate(self.vocab.bytes_of) if i not in special}
        self.library = tiktoken.Encoding(
            "packing", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}
        )

    def _word(self, word: str) -> bytes:
        if word[-1:] in (",", ".", "|") and word[-2:-1].isalpha():
            return self.word_ids[word[:-1]] + self.piece_ids[word[-1]]
        return packed(self.library.encode_ordinary(" " + word))

    def plain(self, text: str) -> Iterable[bytes]:
        return [packed(self.library.encode_ordinary(text))]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> _LibraryEncoder:
    return _LibraryEncoder(path)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    length: int = LENGTH,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``. A document is its
    text's ids (none for a null text) and ``end_id``, so even an empty one is a piece. Each
    task packs its own rows, ``window`` tokens at a time, without a shuffle: a hot source or a
    very long text is only more windows. Whole sequences are cut off long documents first; the
    rest is packed by ``balanced``. What fits no full sequence moves on to the next window, and
    a task's last tokens fill sequences of power-of-two length, so nothing is padded.
    """

    def run(batches):
        ids_of = tokenizer(tokenizer_path).encode
        end = np.asarray([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []  # (document, its tokens, start, ids)
        held, sequences = 0, 0

        def sequences_of(last: bool):
            nonlocal waiting, held, sequences
            out, rest = [], []
            for doc, total, start, ids in waiting:
                whole = len(ids) // 4 // length * length
                for at in range(0, whole, length):
                    part = ids[4 * at : 4 * (at + length)]
                    out.append((doc, start + at, length, part, total, base + sequences, 0))
                    sequences += 1
                if len(ids) > 4 * whole:
                    rest.append((doc, total, start + whole, ids[4 * whole :]))
            sizes = [len(x[3]) // 4 for x in rest]
            room = capacities(sum(sizes), length, last)
            done = [0] * len(rest)
            for piece, start, taken, sequence, offset in balanced(sizes, room):
                doc, total, first, ids = rest[piece]
                part = ids[4 * start : 4 * (start + taken)]
                out.append((doc, first + start, taken, part, total, base + sequences + sequence, offset))
                done[piece] = start + taken
            sequences += len(room)
            waiting = [
                (doc, total, first + d, ids[4 * d :])
                for d, size, (doc, total, first, ids) in zip(done, sizes, rest)
                if d < size
            ]
            held = sum(len(x[3]) // 4 for x in waiting)
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            for at in range(0, len(out), 1024):
                yield dict(zip(names, zip(*out[at : at + 1024])))

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of(value or "") + end
                waiting.append((doc, len(ids) // 4, 0, ids))
                held += len(ids) // 4
                if held >= window:
                    yield from sequences_of(False)
        yield from sequences_of(True)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = (
        "doc_id long, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    return map_batches(source, run, schema)
