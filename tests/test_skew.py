"""A third of all rows in one key: adaptive execution splits it and results stay whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import history, waits, writes

ROWS = 60_000
SMALL_SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
}


@contextlib.contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def rows(spark):
    """Many map tasks, a third of the rows for one task, key and event name."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, ROWS, 1, 16).select(
        F.lit("q").alias("queue"),
        key.alias("key"),
        F.expr("timestamp_seconds(1700000000 + id)").alias("ts"),
        F.col("id").alias("seq"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def run(spark, df):
    """Rows of the result and whether a join was split."""
    with settings(spark, SMALL_SIZES):
        found = df()
        split = found.select(F.xxhash64(*found.columns))
        count = split.count()
        plan_df = found.groupBy().agg(F.count("*"), F.max(F.xxhash64(*found.columns)))
        plan_df.collect()
        plan = plan_df._jdf.queryExecution().executedPlan().toString()
    return count, plan


def test_hot_key_of_requests_is_split(spark, rows):
    requests = rows.select(
        F.col("seq").cast("string").alias("request_id"), "queue",
        F.col("key").alias("idempotency_key"), F.col("ts").alias("requested_at"), "payload",
    )
    count, plan = run(spark, lambda: history.dedupe_requests(requests))
    assert count == ROWS
    assert "skew=true" in plan
    created = history.dedupe_requests(requests).where("created").count()
    assert created == requests.select("idempotency_key").distinct().count()


def test_hot_event_name_of_waits_is_split(spark, rows):
    wait = rows.select(
        F.col("seq").cast("string").alias("wait_id"), "queue", F.col("key").alias("event_name"),
        F.col("ts").alias("wait_ts"), F.lit(10).cast("long").alias("timeout_s"),
        F.col("payload").alias("note"),
    )
    events = rows.select("queue", F.col("key").alias("event_name"), "payload",
                         F.col("ts").alias("emitted_at"), "seq")
    now = F.lit("2030-01-01").cast("timestamp")
    count, plan = run(spark, lambda: waits.resolve_waits(wait, events, now))
    assert count == ROWS
    assert "skew=true" in plan


def test_hot_task_history_is_split(spark, rows):
    op = F.when(F.col("seq") < 20_000, "spawn").when(F.col("seq") % 7 == 0, "claim").otherwise(
        "heartbeat"
    )
    transitions = rows.select(
        "queue", F.col("key").alias("task_id"), F.col("payload").alias("run_id"),
        F.lit(1).alias("attempt"), F.lit(1).alias("max_attempts"), F.lit("t").alias("task_name"),
        op.alias("op"), "ts", "seq", "payload", F.lit(None).cast("timestamp").alias("wake_at"),
        F.lit(60).cast("long").alias("lease_s"), F.lit(None).cast("string").alias("event_name"),
    )
    cut = lambda: history.fold_state(transitions, rows_per_segment=4_000)
    count, plan = run(spark, cut)
    assert count == transitions.select("task_id").distinct().count()
    # The window runs over segments of the hot task, and joins of its rows are split.
    assert "_segment" in plan
    assert "skew=true" in plan
    assert cut().exceptAll(history.fold_state(transitions)).isEmpty()


def test_hot_task_of_writes_is_split(spark, rows):
    snapshot = rows.select(
        "queue", F.col("key").alias("task_id")).distinct().select(
        "*", F.lit("r").alias("run_id"), F.lit(1).alias("attempt"), F.lit(3).alias("max_attempts"),
        F.lit("t").alias("task_name"), F.lit("running").alias("state"),
    )
    requests = rows.select("queue", F.col("key").alias("task_id"), "ts", "seq", "payload")
    count, plan = run(spark, lambda: writes.complete(snapshot, requests))
    assert count == ROWS
    assert "skew=true" in plan
    done = writes.complete(snapshot, requests)
    assert done.where("accepted").count() == snapshot.count()
