"""Hashed word shingles of whole texts."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

CHUNK = 1 << 20  # bytes hashed at a time
MIX = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_VALUES = np.array(
    [int.from_bytes(blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)],
    np.uint64,
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    base = 0xD6E8FEB86659FD93

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grown(self, size: int):
        if len(self.up) < size:
            size = max(size, 1 << 14)
            for name, factor in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                table = np.full(size, np.uint64(factor))
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))
        return self


_POWERS = _Powers()


def _chunk_hashes(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64)
    powers = _POWERS.grown(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * powers.up[: len(codes)], dtype=np.uint64, out=total[1:])
    space = np.ones(len(codes) + 2, bool)
    space[1:-1] = _IS_SPACE[codes]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = (total[ends] - total[starts]) * powers.down[starts]
    return _mixed(sums + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, in order; A to Z count as lower case.

    A word's hash depends on its bytes alone, so equal words agree across texts and machines.
    Long texts are hashed in chunks that end at white space.
    """
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= CHUNK:
        return _chunk_hashes(data)
    found, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and not _IS_SPACE[data[end]]:
            end += 1
        found.append(_chunk_hashes(data[at:end]))
        at = end
    return np.concatenate(found)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words.

    A text with fewer words is one shingle of all of them; without words the set is empty.
    """
    hashes = word_hashes(text or "")
    size = min(words, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    found = np.full(count, np.uint64(size))
    for at in range(size):
        found = _mixed((found * MIX) ^ hashes[at : at + count])
    return np.unique(found)


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id of a whole set."""
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
