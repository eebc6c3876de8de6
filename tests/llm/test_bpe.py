"""The BPE transducer against the public library."""

import random

import numpy as np
import pytest

from tallyfold.llm import bpe
from tallyfold.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")

PARTS = [
    "a", "the", "é", " ", "  ", "\n", "\t", " \n", "1", "23", "'s", "'re", "'", "!!", "***", "日本",
    "x" * 70, "\xa0", "<|endoftext|>", "\x1c", "ation", "ABC", "_", "😀", "\r\n", ",", ".", "|", " ",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(vocabulary_path())


def numbers(data):
    return np.frombuffer(data, "<u4").tolist()


def test_random_texts(library, coder):
    rng, decoder = random.Random(5), bpe.Decoder(vocabulary_path())
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert numbers(coder.encode(text)) == ids
        assert decoder.decode(coder.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_pieces_longer_than_a_chunk(library, coder, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 64)
    rng = random.Random(6)
    kinds = ([" ", "\n", "\t", "  "], ["a", "th", "ation"], ["1", "22"], ["!", "?*", "'"], ["é", "日"])
    for i in range(300):
        run = "".join(rng.choice(kinds[i % 5]) for _ in range(rng.randint(60, 500)))
        text = rng.choice(["", "b", " "]) + run + rng.choice(["!", " b", "", "  ", "q", "1"])
        assert numbers(b"".join(coder.plain(text))) == library.encode(text, add_special_tokens=False).ids


def test_tokens_before_the_lookahead_never_change():
    vocab, rng = bpe.vocabulary(vocabulary_path()), random.Random(7)
    for _ in range(150):
        text = "".join(rng.choice(["th", "e", "tion", "in", "a", "ing", "er", "z"]) for _ in range(700)).encode()
        whole, half = bpe.merged(text, vocab), bpe.merged(text[:900], vocab)
        at = 0
        for token, other in zip(half, whole):
            at += len(vocab.bytes_of[token])
            if at > 900 - vocab.lookahead:
                break
            assert token == other


def test_transducer_keeps_a_bounded_window():
    vocab = bpe.vocabulary(vocabulary_path())
    transducer, data, found = bpe.Transducer(vocab), b"thequickation" * 2000, []
    for at in range(0, len(data), 100):
        found += transducer.push(data[at : at + 100])
        assert len(transducer.waiting) <= vocab.lookahead + transducer.step + 100
    assert found + transducer.finish() == bpe.merged(data, vocab)


def test_invalid_bytes_decode_as_in_the_library(library):
    decoder, rng = bpe.Decoder(vocabulary_path()), random.Random(8)
    for _ in range(500):
        ids = [rng.randrange(50257) if rng.random() < 0.3 else rng.randrange(256) for _ in range(12)]
        assert decoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_frames(spark, library):
    rows = [(1, None), (2, ""), (3, "Hi, you"), (3, "Hi, you"), (None, "x" * 300_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, ids int, n_tokens int")
    out = bpe.decode(bpe.encode(docs, vocabulary_path()), vocabulary_path()).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in out) == sorted(
        (i or 0, len(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows
    )
    assert bpe.encode(docs.limit(0), vocabulary_path()).count() == 0
