"""Stored history: schema version, partitions and pruning."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.session import new_path, written
from tallyfold.sources.tables import SchemaMismatch, read_history, write_history


def transitions(spark, n=40):
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7200)
    rows = spark.range(n).select(
        F.concat(F.lit("q"), (F.col("id") % 2).cast("string")).alias("queue"),
        F.col("id").cast("string").alias("task_id"), F.lit("spawn").alias("op"),
        stamp.alias("ts"), F.col("id").alias("seq"),
    )
    missing = [f for f in S.TRANSITIONS if f.name not in rows.columns]
    return rows.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
    ).select(*S.TRANSITIONS.names)


@pytest.mark.parametrize("mode", ["unpartitioned", "partitioned"])
def test_round_trip(spark, mode):
    path, rows = new_path(spark, "history"), transitions(spark)
    write_history(rows, path, storage_mode=mode)
    write_history(rows.withColumn("seq", F.col("seq") + 100), path, storage_mode=mode)
    stored = read_history(spark, path, "transitions")
    assert stored.columns == S.TRANSITIONS.names
    assert stored.count() == 80
    assert read_history(spark, path, "transitions", queue="q1").count() == 40
    cut = F.lit(datetime(2023, 11, 15)).cast("timestamp")
    assert 0 < read_history(spark, path, "transitions", as_of=cut).count() < 80


def test_queue_filter_prunes_partitions(spark):
    path = new_path(spark, "pruned")
    write_history(transitions(spark), path, storage_mode="partitioned")
    plan = read_history(spark, path, "transitions", queue="q1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(queue" in text


def test_other_schema_version_is_refused(spark):
    path = new_path(spark, "old")
    transitions(spark).withColumn("schema_version", F.lit("0.4.0")).write.partitionBy(
        "queue"
    ).parquet(path)
    with pytest.raises(SchemaMismatch, match="0.4.0"):
        read_history(spark, path, "transitions")


def test_unknown_storage_mode_is_refused(spark):
    with pytest.raises(ValueError):
        write_history(transitions(spark), new_path(spark, "x"), storage_mode="sharded")


def test_written_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before = shuffled()
    written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffled() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
