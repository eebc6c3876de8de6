"""Packing: every id once, no padding, balanced costs."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyfold.llm import packing
from tallyfold.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    None, "", " ", "a", "Hello world, it's 9 o'clock.\n\n  Bye ", "<|endoftext|> and <|endoftext|>",
    "word " * 5000, "é日本 " * 300, "x" * 9000, "same", "same",
]


def check(rows, texts, length):
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    expected = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0 and r.doc_tokens == len(expected[r.doc_id])
    for doc, ids in enumerate(expected):
        at = 0
        for start, piece in sorted(by_doc[doc]):
            assert start == at and piece == ids[at : at + len(piece)]
            at += len(piece)
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == length or (at < length and at & (at - 1) == 0)


@pytest.mark.parametrize("window", [1 << 20, 3000])
def test_every_id_once_and_no_padding(spark, window):
    texts = TEXTS + [f"number {i} " * (i % 50) for i in range(200)]
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in enumerate(texts)], "doc_id long, text string, start int, ids int")
    rows = packing.pack(docs.repartition(3), vocabulary_path(), 1, window=window).collect()
    check(rows, texts, packing.LENGTH)


def test_checksum_of_the_query(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(0, "a b")], "doc_id long, text string")
    row = packing.pack(docs, vocabulary_path(), 1).withColumn("crc", F.crc32("ids")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))


def test_long_pieces_go_to_the_cheapest_sequence():
    placed = list(packing.balanced([8, 6, 5, 4, 1], [12, 12]))
    where = {piece: sequence for piece, _, _, sequence, _ in placed}
    assert where[0] == 0 and where[1] == 1 and where[2] == 1 and where[3] == 0
    assert sum(taken for _, _, taken, _, _ in placed) == 24


def test_costs_are_near_equal():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 300, 2000).tolist()
    room = packing.capacities(sum(lengths), 2048, True)
    spent = np.zeros(len(room))
    for _, _, taken, sequence, _ in packing.balanced(lengths, room):
        spent[sequence] += packing.cost(taken)
    full = spent[np.array(room) == 2048]
    assert full.std() / full.mean() < 0.05


def test_null_id_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [r.doc_id for r in packing.pack(docs, vocabulary_path(), 1).collect()] == [None, None]
    assert packing.pack(docs.limit(0), vocabulary_path(), 1).count() == 0
