"""Byte-level BPE as a streaming transducer with bounded lookahead.

Encoding needs only a bounded window of bytes: a token is emitted as soon as no later byte can
change it. The bound comes from the merge list (``sufficient_lookahead``). Decoding feeds the
bytes of each id through an incremental UTF-8 machine.
"""

from __future__ import annotations

import codecs
import heapq
import json
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import map_batches

#: Fixed value: the byte-level vocabulary's split into pieces.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CHUNK = 1 << 16  # characters split at a time
CACHED = 300_000  # entries of a generation of a cache
LONG = 64  # longer words are not cached
NONE = (1 << 62, -1)  # stands for a pair without a merge
TAIL = 4  # characters whose split may depend on what follows


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], size: list[int]) -> int:
    """Bytes after a token that decide whether it stays.

    ``merges`` holds (left, right, result) by rank; ``size`` is the bytes of each token. Bytes
    further right can act on the left only through a chain of merges of rising rank: a merge
    takes the token left of a boundary, or leaves it, and that token starts (as a left part)
    the right side of the next merge of the chain. The longest such chain is found in one pass
    over the ranks; the longest token is added for the first link.
    """
    parent_left: dict[int, int] = {}
    reach: dict[int, int] = {}  # by token: the longest chain that ends by taking it
    longest = 0
    for left, right, result in merges:
        chain, part = 0, right
        while part is not None:
            chain = max(chain, reach.get(part, 0))
            part = parent_left.get(part)
        chain += size[left]
        reach[left] = max(reach.get(left, 0), chain)
        longest = max(longest, chain)
        parent_left.setdefault(result, left)
    return longest + max(size, default=0)


class Vocabulary:
    """Tokens, merge ranks and lookahead of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        tokens = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = [b""] * (max([*tokens.values(), *self.special.values()]) + 1)
        for token, number in tokens.items():
            self.bytes_of[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.of_byte = [tokens[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        rules = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            rule = (tokens[left], tokens[right], tokens[left + right])
            self.ranks.setdefault(rule[:2], (rank, rule[2]))
            rules.append(rule)
        self.lookahead = sufficient_lookahead(rules, [len(b) for b in self.bytes_of])
        self.splits = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merged(data: bytes, vocab: Vocabulary) -> list[int]:
    """All merges of one piece, lowest rank first and leftmost among equals."""
    ids = [vocab.of_byte[b] for b in data]
    find = vocab.ranks.get
    if len(ids) < 96:
        pairs = [find(pair, NONE) for pair in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is NONE:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = find((ids[i], ids[i + 1]), NONE)
            if i:
                pairs[i - 1] = find((ids[i - 1], ids[i]), NONE)
        return ids
    ranks = vocab.ranks
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [
        (found[0], i, pair, found[1])
        for i, pair in enumerate(zip(ids, ids[1:]))
        if (found := ranks.get(pair))
    ]
    heapq.heapify(heap)
    gone = [False] * len(ids)
    while heap:
        _, i, pair, result = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= len(ids) or (ids[i], ids[j]) != pair:
            continue
        ids[i], gone[j] = result, True
        after[i] = after[j]
        if after[i] < len(ids):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(ids):
                pair = (ids[k], ids[after[k]])
                if found := ranks.get(pair):
                    heapq.heappush(heap, (found[0], k, pair, found[1]))
    return [x for x, dead in zip(ids, gone) if not dead]


class Pairs:
    """Short pieces token by token, each token checked against the one before.

    A sequence of tokens is the merge list's result exactly when the merges keep every two
    neighbours as they are. Those answers are remembered, so most pieces need no merging.
    """

    def __init__(self, vocab: Vocabulary):
        special = set(vocab.special.values())
        self.token = {b: i for i, b in enumerate(vocab.bytes_of) if i not in special}
        self.longest = max(map(len, self.token))
        self.vocab, self.known = vocab, {}

    def kept(self, left: int, right: int) -> bool:
        key = left << 20 | right
        found = self.known.get(key)
        if found is None:
            both = self.vocab.bytes_of[left] + self.vocab.bytes_of[right]
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[key] = merged(both, self.vocab) == [left, right]
        return found

    def tokens(self, data: bytes) -> list[int]:
        """The ids of a piece: the longest tokens that fit, going back where none does."""
        ids, ends, at, size = [], [], 0, len(data)
        end, token, kept = min(size, self.longest), self.token.get, self.kept
        while at < size:
            while end > at:
                found = token(data[at:end])
                if found is not None and (not ids or kept(ids[-1], found)):
                    break
                end -= 1
            if end > at:
                ids.append(found)
                ends.append(end)
                at, end = end, min(size, end + self.longest)
            else:
                ids.pop()
                end = ends.pop() - 1
                at = ends[-1] if ends else 0
        return ids


class Transducer:
    """Tokens of one piece whose bytes arrive bit by bit, in constant memory."""

    def __init__(self, vocab: Vocabulary, step: int = 0):
        self.vocab, self.waiting = vocab, b""
        self.step = step or max(256, vocab.lookahead)

    def push(self, data: bytes) -> Iterator[int]:
        """The tokens that these bytes made final."""
        size = self.vocab.lookahead + self.step
        for at in range(0, len(data), self.step):
            self.waiting += data[at : at + self.step]
            while len(self.waiting) >= size:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        done, edge = 0, len(self.waiting) - self.vocab.lookahead
        for token in merged(self.waiting, self.vocab):
            end = done + len(self.vocab.bytes_of[token])
            if end > edge:
                break
            yield token
            done = end
        self.waiting = self.waiting[done:]

    def finish(self) -> list[int]:
        """The rest of the piece; the transducer is then ready for the next."""
        data, self.waiting = self.waiting, b""
        return merged(data, self.vocab) if data else []


class _Cache(dict):
    """Remembers the ids of words in two generations, so its memory is bounded."""

    def __init__(self, encode, most: int = CACHED):
        super().__init__()
        self.encode, self.old, self.most = encode, {}, most

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.encode(key)
        if len(key) <= LONG:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def packed(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(list(ids), "<u4").tobytes()


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.pieces = regex.compile(PIECES)
        self.runs = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]
        self.spaces = regex.compile(r"\s+")
        self.loose = regex.compile(r" \s")
        self.piece_ids = _Cache(self._piece)
        self.word_ids = _Cache(self._word)
        self.pairs = Pairs(self.vocab)

    def _piece(self, piece: str) -> bytes:
        if len(piece) <= LONG:
            return packed(self.pairs.tokens(piece.encode()))
        transducer = Transducer(self.vocab)
        return packed([*transducer.push(piece.encode()), *transducer.finish()])

    def _word(self, word: str) -> bytes:
        """Ids of a word and the space before it."""
        if len(word) > LONG:
            return b"".join(self.plain(" " + word))
        if word[-1:] in (",", ".", "|") and word[-2:-1].isalpha():  # the mark is its own piece
            return self.word_ids[word[:-1]] + self.piece_ids[word[-1]]
        return b"".join(map(self.piece_ids.__getitem__, self.pieces.findall(" " + word)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; strings of special tokens become their ids."""
        if self.vocab.splits is None or not self.vocab.splits.search(text):
            return b"".join(self._segment(text))
        found, at = [], 0
        for match in self.vocab.splits.finditer(text):
            found += self._segment(text[at : match.start()])
            found.append(np.asarray([self.vocab.special[match[0]]], "<u4").tobytes())
            at = match.end()
        return b"".join([*found, *self._segment(text[at:])])

    def _segment(self, text: str) -> Iterable[bytes]:
        # Before a space that a visible character follows a piece always ends, so words can
        # be encoded one by one, each with its space.
        if text.endswith(" ") or self.loose.search(text):
            return self.plain(text)
        first, *words = text.split(" ")
        return [*self.plain(first), *map(self.word_ids.__getitem__, words)]

    def plain(self, text: str) -> Iterator[bytes]:
        """Ids of a text piece by piece, reading ``CHUNK`` characters at a time."""
        transducer, run, held = Transducer(self.vocab), None, ""
        for at in range(0, len(text), CHUNK):
            held += text[at : at + CHUNK]
            last = at + CHUNK >= len(text)
            edge = len(held) if last else len(held) - TAIL
            done = 0
            if run is not None:  # the piece that filled the chunk before goes on
                match = run.match(held, 0, edge)
                done = match.end() if match else 0
                closed = done < edge or last
                if run is self.spaces and done and (not closed or done < len(held)):
                    done -= 1  # the last space may belong to the next piece
                yield packed(transducer.push(held[:done].encode()))
                if closed:
                    yield packed(transducer.finish())
                    run = None
            if run is None:
                for match in self.pieces.finditer(held, done):
                    if match.end() > edge:
                        break
                    yield self.piece_ids[match[0]]
                    done = match.end()
                if not last and len(held) - done > CHUNK:  # one piece larger than a chunk
                    run = self.spaces
                    if not held[done : done + 2].isspace():
                        first = held[done + (held[done] == " ")]
                        run = next(r for r in self.runs if r.match(first))
                    elif edge - done > 1:
                        edge -= 1
                    yield packed(transducer.push(held[done:edge].encode()))
                    done = edge
            held = held[done:]


class Decoder:
    """Ids to text: the bytes of each id through an incremental UTF-8 machine."""

    def __init__(self, path: str):
        self.bytes_of = vocabulary(path).bytes_of

    def decode(self, ids: bytes) -> str:
        """The text; bytes that are no UTF-8 become replacement characters."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        found = []
        for at in range(0, len(ids), 4 * CHUNK):
            numbers = np.frombuffer(ids[at : at + 4 * CHUNK], "<u4").tolist()
            found.append(machine.decode(b"".join(map(self.bytes_of.__getitem__, numbers))))
        found.append(machine.decode(b"", True))
        return "".join(found)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of every whole text as little-endian 32-bit integers.

    A null text counts as empty and has no ids. Rows keep their partitions; repeated rows stay
    repeated; columns other than the two named are not read.
    """

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            ids = [coder.encode(t or "") for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with its ids decoded into ``decoded``; null ids give a null text."""

    def run(batches):
        coder = decoder(path)
        for batch in batches:
            texts = [None if x is None else coder.decode(x) for x in batch.column(2).to_pylist()]
            yield {
                "doc_id": batch.column(0), "n_tokens": batch.column(1),
                "ids": batch.column(2), "decoded": texts,
            }

    source = encoded.select("doc_id", "n_tokens", "ids")
    return map_batches(source, run, "doc_id long, n_tokens long, ids binary, decoded string")
