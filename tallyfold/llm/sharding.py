"""Shards by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.session import written

SLOTS = 4096


def slotted(docs: DataFrame, doc_id: str, text: str, slots: int = SLOTS) -> DataFrame:
    """Size, checksum and virtual slot of every record.

    A record's slot is a hash of its id and the checksum of its text, so neither a hot source
    nor records without an id meet in one slot. Records that repeat with the same id and text
    are dealt over slots by a number that their place in the input gives; which of the
    copies goes where means nothing. Null and empty texts have size 1 and checksum
    0. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    crc = F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0).cast("long"))
    rows = written(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            crc.alias("text_crc32"),
        ),
        "sizes",
    )
    same = ["doc_id", "text_crc32", "size"]
    copies = written(rows.groupBy(same).agg(F.count("*").alias("n")).filter("n > 1"), "copies")
    hit = [rows[c].eqNullSafe(copies[c]) for c in same]
    place = F.pmod(F.monotonically_increasing_id(), F.coalesce(copies["n"], F.lit(1)))
    spread = rows.join(copies, hit, "left").select(*[rows[c] for c in rows.columns], place.alias("place"))
    return spread.withColumn(
        "virtual_slot", F.pmod(F.xxhash64(*same, "place"), F.lit(slots)).cast("int")
    ).drop("place")


def slot_loads(slotted_docs: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of every slot; at most ``slots`` rows reach the driver."""
    loads, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    sums = slotted_docs.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    for row in sums.collect():
        loads[row.virtual_slot], rows[row.virtual_slot] = row["bytes"], row["n"]
    return loads, rows


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """Version 1 of a map: slots dealt round to the shards."""
    return np.arange(slots) % shards


def rebalanced(shard_of: np.ndarray, loads: np.ndarray, shards: int) -> np.ndarray:
    """The next version of a map: edits until no move or swap evens out the extremes.

    Each step takes the fullest and the emptiest shard and moves the slot, or swaps the two
    slots, that brings them closest to each other. Ties go to the smaller slot. Slots that
    hold nothing stay where they are. Works on the slots alone, whatever the data size.
    """
    shard_of, totals = shard_of.copy(), np.zeros(shards, np.int64)
    np.add.at(totals, shard_of, loads)
    for _ in range(64 * len(loads)):
        high, low = int(totals.argmax()), int(totals.argmin())
        gap = totals[high] - totals[low]
        giving = np.flatnonzero((shard_of == high) & (loads > 0))
        taking = np.append(np.flatnonzero((shard_of == low) & (loads > 0)), -1)
        back = np.append(loads[taking[:-1]], 0)
        order = np.argsort(back, kind="stable")
        # The best partner of each slot given away: what comes back leaves half of the gap.
        at = np.searchsorted(back[order], loads[giving] - gap / 2)
        best = None
        for shift in (0, -1):
            index = np.clip(at + shift, 0, len(order) - 1)
            moved = loads[giving] - back[order][index]
            off = np.where((moved > 0) & (moved < gap), np.abs(moved - gap / 2), np.inf)
            if len(off) and off.min() < (best[0] if best else np.inf):
                k = int(off.argmin())
                best = (off[k], giving[k], taking[order[index[k]]], moved[k])
        if best is None:
            return shard_of
        _, gone, got, moved = best
        shard_of[gone] = low
        if got >= 0:
            shard_of[got] = high
        totals[high] -= moved
        totals[low] += moved
    return shard_of


def slot_map(
    spark: SparkSession, version: int, shard_of: np.ndarray, loads: np.ndarray, rows: np.ndarray
) -> DataFrame:
    """One version of a map as a table, with each slot's first position in its shard."""
    first = np.zeros(len(shard_of), np.int64)
    for shard in np.unique(shard_of):
        own = shard_of == shard
        first[own] = np.cumsum(rows[own]) - rows[own]
    return spark.createDataFrame(
        [
            (version, slot, int(shard_of[slot]), int(loads[slot]), int(rows[slot]), int(first[slot]))
            for slot in range(len(shard_of))
        ],
        "version int, virtual_slot int, shard int, bytes long, rows long, first long",
    )


def shard(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> tuple[DataFrame, DataFrame]:
    """Every record with its shard and position, and the stored versions of the slot map.

    Returns (``doc_id, size, text_crc32, virtual_slot, shard, slot``, map versions). Shard
    sizes in bytes differ by little; ``slot`` counts each shard's records from 0. Equal rows
    keep one position each. An empty table gives no rows and a map of empty slots.
    """
    spark = docs.sparkSession
    sized = written(slotted(docs, doc_id, text, slots), "slotted")
    loads, rows = slot_loads(sized, slots)
    start = first_map(shards, slots)
    edited = rebalanced(start, loads, shards)
    versions = written(
        slot_map(spark, 1, start, loads, rows).union(slot_map(spark, 2, edited, loads, rows)),
        "slot-map",
    )
    current = versions.filter("version = 2").select("virtual_slot", "shard", "first")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    placed = (
        sized.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(current), "virtual_slot")  # at most ``slots`` rows
        .withColumn("slot", F.col("first") + F.col("place"))
        .drop("first", "place")
    )
    return placed, versions
