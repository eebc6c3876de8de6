"""Streams over several files, in several micro-batches, against the batch operators."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import history, observe, waits
from tallyfold.queries.streams import ROCKSDB, plain_times
from tallyfold.queries.views import view
from tallyfold.session import new_path
from tallyfold.streaming import events, timers
from tallyfold.streaming import waits as stream_waits

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
SF_LARGER = "/root/testdata/sf0.01"
LATE = 600


@pytest.fixture(scope="module")
def source(spark):
    """The events in four files by time, and a view over them as a stream of four batches."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    folder = new_path(spark, "split-events")
    for part, (low, high) in enumerate([(1, 9), (9, 16), (16, 24), (24, 32)]):
        day = F.dayofmonth("ts")
        rows.where((day >= low) & (day < high)).coalesce(1).write.parquet(f"{folder}/p={part}")

    def stream(name):
        reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
        found = view(spark, SF_DIR, name, events=reader.parquet(f"{folder}/p=*").drop("p"))
        times = [f.name for f in found.schema if f.dataType.typeName() == "timestamp_ntz"]
        return found.withColumns({c: F.col(c).cast("timestamp") for c in times})

    return stream


def run(df, label, each_batch=None):
    spark = df.sparkSession
    out = new_path(spark, label)
    writer = df.writeStream.trigger(availableNow=True)
    writer = writer.option("checkpointLocation", f"{out}/checkpoint")
    if each_batch:
        query = writer.foreachBatch(each_batch).outputMode("update").start()
    else:
        query = writer.format("parquet").option("path", f"{out}/rows").start()
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 3
    return None if each_batch else plain_times(spark.read.schema(df.schema).parquet(f"{out}/rows"))


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def watermark(spark, df, column="ts"):
    last = df.agg(F.max(column)).first()[0]
    return F.lit(last).cast("timestamp_ntz") - F.expr(f"interval {LATE} seconds")


def test_waits_settle_once(spark, source):
    ours = run(stream_waits.settled_waits(source("waits"), source("signals")), "waits")
    wait, signal = view(spark, SF_DIR, "waits"), view(spark, SF_DIR, "signals")
    both = wait.select(F.col("wait_ts").alias("ts")).unionByName(
        signal.select(F.col("emitted_at").alias("ts"))
    )
    now = watermark(spark, both)
    batch = waits.resolve_waits(wait, signal, F.lit("2100-01-01").cast("timestamp_ntz"))
    batch = batch.where((F.col("status") == "resolved") | (F.col("resolved_at") <= now))
    batch = batch.where(F.col("status") != "sleeping")
    columns = ["wait_id", "status", "payload", "resolved_at"]
    assert rows(ours, *columns) == rows(batch, *columns)
    assert ours.where("status = 'timed_out'").count() > 0


def test_joined_waits_keep_resolved_ones(spark, source):
    finite = source("waits").where("timeout_s IS NOT NULL")
    ours = run(stream_waits.joined_waits(finite, source("signals")), "joined")
    assert ours.where("emitted_at IS NULL").count() > 0
    assert ours.where("emitted_at >= deadline").count() == 0


def test_lease_alerts(spark, source):
    ours = run(timers.deadline_alerts(source("beats"), timers.lease_deadlines()), "alerts")
    beats = view(spark, SF_DIR, "beats")
    now = watermark(spark, beats)
    ages = observe.lease_status(beats, F.lit("2100-01-01").cast("timestamp_ntz"))
    end = F.least("until", now)
    levels = {"warning": "warning_at", "expired": "expires_at"}
    warned, expired = (
        ages.select(
            "run_id", "seq", F.lit(n).alias("level"), F.col(c).alias("due_at"), end.alias("end")
        )
        for n, c in levels.items()
    )
    both = warned.unionByName(expired)
    columns = ["run_id", "seq", "level", "due_at"]
    assert rows(ours, *columns) == rows(both.where("due_at <= end"), *columns)


def test_woken_runs(spark, source):
    rows_in = source("transitions").where("op = 'schedule'")
    ours = run(timers.deadline_alerts(rows_in, timers.wake_deadlines()), "woken")
    whole = view(spark, SF_DIR, "transitions").where("op = 'schedule'")
    following = Window.partitionBy("run_id").orderBy("ts", "seq")
    end = F.coalesce(F.lead("ts").over(following), watermark(spark, whole))
    woken = whole.withColumn("end", end).where("wake_at <= end")
    assert rows(ours, "run_id", "seq", "due_at") == rows(woken, "run_id", "seq", "wake_at")


BEATS = "run_id string, ts timestamp, seq long, lease_s long, ended boolean"


def beats(spark, *batches):
    """A stream of one batch per argument: (run, second, lease, ended) rows."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    folder, start = new_path(spark, "beats"), datetime(2026, 1, 1)
    for i, batch in enumerate(batches):
        made = [(r, start + timedelta(seconds=s), s, lease, end) for r, s, lease, end in batch]
        spark.createDataFrame(made, BEATS).coalesce(1).write.parquet(f"{folder}/p={i}")
    reader = spark.readStream.schema(BEATS).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/p=*").drop("p")


def raised(spark, stream, **options):
    found = run(timers.deadline_alerts(stream, timers.lease_deadlines(), **options), "raised")
    return {(r.run_id, r.seq, r.level) for r in found.collect()}


def test_ended_runs_raise_nothing_and_shorter_leases_replace_longer_ones(spark):
    found = raised(
        spark,
        beats(
            spark,
            [("a", 0, 10, None), ("b", 1, 10, None), ("d", 0, 100, None)],
            [("a", 5, 10, True), ("d", 6, 2, None), ("c", 12, 10, None)],
            [("c", 40, 10, False), ("x", 60, 1, None)],
            [("x", 61, 1, None)],
        ),
        late="0 seconds",
    )
    assert found >= {("b", 1, "warning"), ("b", 1, "expired"), ("c", 12, "warning"),
                     ("c", 12, "expired"), ("d", 6, "warning"), ("d", 6, "expired")}
    assert not {f for f in found if f[:2] in {("a", 0), ("a", 5), ("d", 0)}}


def test_heartbeats_within_the_lateness_replace_and_raise(spark):
    """Two beats come a batch late: the first lease raises nothing, their own deadlines do."""
    found = raised(
        spark,
        beats(
            spark,
            [("a", 0, 60, None), ("z", 400, 1000, None)],
            [("a", 90, 60, None), ("a", 45, 60, None), ("z", 500, 1000, None)],
            [("z", 1200, 1000, None)],
            [("z", 1300, 1000, None)],
        ),
        late="10 minutes",
    )
    assert found == {("a", 90, "warning"), ("a", 90, "expired")}


def test_a_deadline_beyond_the_bound_is_an_error(spark):
    with pytest.raises(Exception, match="longest_s"):
        raised(spark, beats(spark, [("a", 0, 90, None)], [], [], []), longest_s=100)


@pytest.mark.parametrize("late_s", [0, 900])
def test_a_snapshot_stream_with_rows_out_of_order(spark, late_s):
    """Within the lateness any order gives the batch fold; later rows go to the side table."""
    store, whole = new_path(spark, "disorder"), view(spark, SF_LARGER, "transitions")
    keep = events.snapshot_batches(store, late_s)
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    arrival = at + F.when(F.col("seq") % 3 == 0, 890).otherwise(0)
    batch = F.floor((arrival - 1704067200) / (4 * 86400)).cast("int")
    table = whole.withColumn("_batch", batch).persist()
    last = table.agg(F.max("_batch")).first()[0]
    for i in range(last + 1):
        rows_in = table.where(F.col("_batch") == i).drop("_batch")
        keep(rows_in.withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "wake_at")}), i)
    ours = plain_times(events.latest_snapshot(spark, store, last))
    late = events.late_rows(spark, store).select("queue", "task_id", "seq")
    assert (late.count() > 0) == (late_s == 0)
    kept = whole.join(late, ["queue", "task_id", "seq"], "left_anti")
    batch_fold = history.fold_state(kept)
    assert rows(ours, *batch_fold.columns) == rows(batch_fold, *batch_fold.columns)


def test_a_replayed_snapshot_batch_changes_nothing(spark):
    store, whole = new_path(spark, "replay"), view(spark, SF_DIR, "transitions")
    keep = events.snapshot_batches(store, 600)
    rows_in = whole.withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "wake_at")})
    parts = [rows_in.where(F.floor(F.dayofmonth("ts") % 31 / 8) == i) for i in range(4)]
    for i in (0, 0, 1, 2, 2, 3):
        keep(parts[i], i)
    ours = plain_times(events.latest_snapshot(spark, store, 3))
    late = events.late_rows(spark, store).select("queue", "task_id", "seq")
    kept = history.fold_state(whole.join(late, ["queue", "task_id", "seq"], "left_anti"))
    assert rows(ours, *kept.columns) == rows(kept, *kept.columns)


def test_submit_spawns_each_key_once(spark, source):
    store = new_path(spark, "submit-store")
    run(source("requests"), "submit", events.submit_batches(store))
    ours = spark.read.parquet(store)
    batch = history.dedupe_requests(view(spark, SF_DIR, "requests")).where("created")
    assert rows(ours, "request_id", "queue") == rows(batch, "request_id", "queue")


def test_replayed_submit_batch_replaces_its_rows(spark):
    store = new_path(spark, "replayed")
    keep = events.submit_batches(store)
    batch = view(spark, SF_DIR, "requests")
    keep(batch, 0)
    first = spark.read.parquet(store).count()
    keep(batch, 0)
    assert spark.read.parquet(store).count() == first
    keep(batch.where("idempotency_key IS NOT NULL"), 1)
    assert spark.read.parquet(store).count() == first


def test_snapshot_after_every_batch(spark, source):
    store, seen = new_path(spark, "snapshots"), []
    keep = events.snapshot_batches(store)

    def each(batch, batch_id):
        keep(batch, batch_id)
        seen.append(batch_id)

    run(source("transitions"), "snapshot", each)
    assert len(seen) == 4
    ours = plain_times(events.latest_snapshot(spark, store, seen[-1]))
    whole = history.fold_state(view(spark, SF_DIR, "transitions"))
    assert rows(ours, *whole.columns) == rows(whole, *whole.columns)


def test_first_events_in_update_mode(spark, source):
    store = new_path(spark, "first")

    def keep(batch, batch_id):
        batch.write.parquet(f"{store}/batch={batch_id}")

    run(events.first_events_running(source("signals")), "first-run", keep)
    newest = spark.read.parquet(store).groupBy("queue", "event_name").agg(
        F.max_by("payload", "batch").alias("payload")
    )
    whole = history.first_events(view(spark, SF_DIR, "signals"))
    columns = ["queue", "event_name", "payload"]
    assert rows(newest, *columns) == rows(whole, *columns)


@pytest.mark.parametrize("ttl", [None, "60 days"])
def test_first_arrivals_keep_one_row_per_name(spark, source, ttl):
    ours = run(events.first_arrivals(source("signals"), ttl=ttl), "arrivals")
    names = view(spark, SF_DIR, "signals").select("queue", "event_name").distinct()
    assert rows(ours, "queue", "event_name") == rows(names, "queue", "event_name")
