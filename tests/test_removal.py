"""Rows and queues removed from stored tables: what goes, what stays, which files are touched."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.session import new_path
from tallyfold.sources.tables import (
    drop_stored_queues,
    read_history,
    remove_rows,
    write_history,
)

KEY = ["queue", "event_name"]


def events(spark, queues=("a", "b c/é", "d")):
    """Ten days of three events each in every queue."""
    names = F.array(*map(F.lit, queues))
    return spark.range(30 * len(queues)).select(
        F.get(names, (F.col("id") % len(queues)).cast("int")).alias("queue"),
        F.concat(F.lit("e"), F.col("id")).alias("event_name"),
        F.lit("{}").alias("payload"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / (3 * len(queues))) * 86_400).alias("emitted_at"),
        F.col("id").alias("seq"),
    )


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def seqs(spark, path, mode):
    return {r.seq for r in read_history(spark, path, "events", storage_mode=mode).collect()}


@pytest.mark.parametrize("mode,changed", [("partitioned", 3), ("unpartitioned", 2)])
def test_only_partitions_that_lose_rows_change(spark, mode, changed):
    path, rows = new_path(spark, "events"), events(spark)
    write_history(rows, path, mode, day_of="emitted_at")
    before = files(path)
    doomed = rows.where("seq IN (0, 1, 4, 10)")  # 0 in a, 1 and 4 in b of one day, 10 in b of the next
    assert remove_rows(spark, path, "events", doomed.union(doomed), KEY, mode) == changed
    after = files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(before) - len(kept) == changed and len(after) == len(before)
    assert seqs(spark, path, mode) == set(range(90)) - {0, 1, 4, 10}
    assert remove_rows(spark, path, "events", doomed, KEY, mode) == 0
    assert files(path) == after


@pytest.mark.parametrize("mode", ["partitioned", "unpartitioned"])
def test_emptied_partitions_go(spark, mode):
    path, rows = new_path(spark, "events"), events(spark)
    write_history(rows, path, mode, day_of="emitted_at")
    remove_rows(spark, path, "events", rows.where("queue = 'b c/é'"), KEY, mode)
    assert seqs(spark, path, mode) == {i for i in range(90) if i % 3 != 1}
    assert not [f for f in files(path) if "queue=b" in f]


def test_nothing_to_remove(spark):
    path, rows = new_path(spark, "events"), events(spark)
    write_history(rows, path, "partitioned", day_of="emitted_at")
    before = files(path)
    other = rows.where("seq < 3").withColumn("event_name", F.lit(None).cast("string"))
    assert remove_rows(spark, path, "events", other, KEY, "partitioned") == 0
    assert remove_rows(spark, path, "events", rows.limit(0), KEY, "partitioned") == 0
    assert files(path) == before


def test_dropped_queues(spark):
    path, rows = new_path(spark, "events"), events(spark)
    write_history(rows, path, "partitioned", day_of="emitted_at")
    before = files(path)
    names = spark.createDataFrame([("b c/é",), ("unknown",), ("b c/é",)], "queue string")
    assert drop_stored_queues(spark, path, "events", names) == 1
    assert seqs(spark, path, "partitioned") == {i for i in range(90) if i % 3 != 1}
    assert all(before[f] == t for f, t in files(path).items())
    assert drop_stored_queues(spark, path, "events", names) == 0
