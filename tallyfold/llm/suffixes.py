"""Two-stage suffix sorting of byte passages, and the common prefixes of neighbours.

Only suffixes smaller than their successor are sorted directly. All others follow from them by a
scan over the buckets of first bytes, smallest first: a suffix larger than its successor comes
into its bucket in the order in which the successors are met. Works within a task on a bounded
number of passages; which passages have to meet is decided by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

WORD = 8


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
    words = np.zeros(len(text), np.uint64)
    for k in range(WORD):
        words = (words << np.uint64(8)) | padded[k : k + len(text)]
    return words


def smaller_than_next(text: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For every position whether its suffix sorts before the next one; never at a passage's end."""
    step = np.zeros(len(text), np.int8)
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    step[last] = -1
    return step[_next_true(step != 0)] > 0


def _next_true(mask: np.ndarray) -> np.ndarray:
    """The first position from each one on where ``mask`` holds; it holds at the end."""
    at = np.where(mask, np.arange(len(mask)), len(mask))
    return np.minimum.accumulate(at[::-1])[::-1]


def _sorted_directly(
    data: bytes, words: np.ndarray, ends: np.ndarray, places: np.ndarray, depth: int
) -> np.ndarray:
    """``places`` by the ``depth`` bytes that follow each within its passage."""
    near = np.flatnonzero(ends[places] - places < WORD)
    first = words[places].copy()
    for i in near:
        left = int(ends[places[i]] - places[i])
        first[i] &= np.uint64(((1 << 64) - 1) ^ ((1 << (8 * (WORD - left))) - 1))
    order = np.argsort(first, kind="stable")
    places, first = places[order], first[order]
    cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
    lows, highs = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(places)]])
    several = highs - lows > 1
    for low, high in zip(lows[several].tolist(), highs[several].tolist()):
        block = places[low:high]
        stops = np.minimum(block + depth, ends[block]).tolist()
        tied = [(data[i:j], i) for i, j in zip(block.tolist(), stops)]
        tied.sort(key=lambda pair: pair[0])
        places[low:high] = [i for _, i in tied]
    return places


def suffix_order(
    data: bytes, text: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray,
    heads: np.ndarray, depth: int,
) -> np.ndarray:
    """The first ``heads[j]`` suffixes of each passage j, sorted by their first ``depth`` bytes.

    Passage j is ``data[starts[j]:ends[j]]``; its end sorts before every byte. A few suffixes
    after the wanted ones come along, where a wanted one is induced from them.
    """
    count = len(text)
    last = ends - 1
    up = smaller_than_next(text, last)
    stops = up.copy()
    stops[last] = True
    until = np.maximum(starts + heads - 1, _next_true(stops)[starts + heads - 1])
    edges = np.zeros(count + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, until + 1, -1)
    need = np.cumsum(edges[:-1]) > 0
    end_of = np.repeat(ends, ends - starts)
    begins = np.zeros(count, bool)
    begins[starts] = True

    direct = _sorted_directly(data, words, end_of, np.flatnonzero(need & up), depth)
    induced = need & ~up
    lists: list[list[np.ndarray]] = [[] for _ in range(256)]

    def place(found: np.ndarray) -> None:
        """Put suffixes into the buckets of their first bytes, in the order given."""
        if len(found):
            first = text[found]
            order = np.argsort(first, kind="stable")
            found, first = found[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(found, cuts):
                lists[text[part[0]]].append(part)

    def before(found: np.ndarray) -> np.ndarray:
        """The suffixes one position earlier that are induced from these."""
        inner = found[~begins[found]] - 1
        return inner[induced[inner]]

    # The empty suffixes come first of all; those before them are one byte long.
    place(last[induced[last]])
    cuts = np.searchsorted(text[direct], np.arange(257))
    order = []
    for byte in range(256):
        rounds = [np.concatenate(lists[byte])] if lists[byte] else []
        while rounds and len(rounds[-1]):
            earlier = before(rounds[-1])
            rounds.append(earlier[text[earlier] == byte])
        bucket = np.concatenate([*rounds, direct[cuts[byte] : cuts[byte + 1]]])
        order.append(bucket)
        earlier = before(bucket)
        place(earlier[text[earlier] > byte])
    return np.concatenate(order).astype(np.int64)


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For neighbours in ``order`` whether their first ``depth`` bytes are equal.

    Both must have ``depth`` bytes left. The prefix is compared in words, and a pair leaves with
    its first difference.
    """
    left, right = order[:-1], order[1:]
    active = np.arange(len(left))
    for k in [*range(0, depth - WORD, WORD), depth - WORD]:
        active = active[words[left[active] + k] == words[right[active] + k]]
    equal = np.zeros(len(left), bool)
    equal[active] = True
    return equal


def repeated_heads(passages: Sequence[bytes], depth: int) -> list[np.ndarray]:
    """Per passage, the positions whose next ``depth`` bytes occur at another position too.

    Positions are of all passages together; ``depth`` is 8 at least, and passages are no shorter.
    """
    data = b"".join(passages)
    sizes = np.array([len(p) for p in passages], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    text = np.frombuffer(data, np.uint8)
    words = _words(text)
    heads = sizes - depth + 1
    order = suffix_order(data, text, words, starts, ends, heads, depth)
    order = order[np.repeat(ends, sizes)[order] - order >= depth]
    equal = common_prefixes(words, order, depth)
    hit = np.zeros(len(text), bool)
    hit[order[:-1][equal]] = True
    hit[order[1:][equal]] = True
    return [np.flatnonzero(hit[s : s + h]) for s, h in zip(starts.tolist(), heads.tolist())]
