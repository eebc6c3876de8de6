"""The history loop with options and events, batch functions, and rounds by wake time."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import fold, tasks, writes
from tallyfold.session import new_path, written

START = datetime(2024, 1, 1)


def at(seconds):
    return F.lit(START + timedelta(seconds=seconds)).cast("timestamp_ntz")


def spawned(spark, **options):
    """One task, submitted with the given options, claimed with a lease of 10 s."""
    given = {"retry_kind": "fixed", "retry_base_seconds": 30.0, **options}
    request = spark.range(1).select(
        F.lit("r").alias("request_id"), F.lit("q").alias("queue"), F.lit("n").alias("task_name"),
        F.lit(None).cast("string").alias("idempotency_key"), F.lit('{"a": 1}').alias("params"),
        F.lit(2).alias("max_attempts"), at(0).alias("requested_at"),
        F.create_map(F.lit("trace"), F.lit("t1")).alias("headers"),
        *(F.lit(v).alias(k) for k, v in given.items()),
    )
    none = "queue string, idempotency_key string, task_id string, run_id string, attempt int"
    rows = kept(writes.spawn_history(writes.submit(spark.createDataFrame([], none), request)))
    return more(rows, writes.claim(state_of(rows), at(1), 1, 10_000))


def kept(rows):
    """Stored, as a history is: each step reads it, not the steps before."""
    return written(rows, "history")


def state_of(rows):
    return kept(fold.fold_state(rows, details=True))


def more(rows, claims):
    return kept(rows.unionByName(writes.claim_history(claims), allowMissingColumns=True))


def request(spark, rows, second, **extra):
    return rows.limit(1).select(
        "queue", "task_id", at(second).alias("ts"), F.lit(9).cast("long").alias("seq"),
        *(F.lit(v).alias(k) for k, v in extra.items()),
    )


def appended(rows, written):
    new = written.where("accepted").select(*[c for c in written.columns if c in rows.columns])
    return kept(rows.unionByName(new, allowMissingColumns=True))


def test_options_come_back_from_the_history(spark):
    row = fold.fold_state(spawned(spark), details=True).first()
    assert (row.state, row.params, row.headers) == ("running", '{"a": 1}', {"trace": "t1"})
    assert row.retry_strategy.base_seconds == 30 and row.spawned_at == START


def test_a_failure_waits_as_the_task_was_spawned(spark):
    rows = spawned(spark)
    state = state_of(rows)
    rows = appended(rows, writes.fail(state, request(spark, rows, 5, payload="{}")))
    row = fold.fold_state(rows, details=True).first()
    assert (row.state, row.attempt, row.wake_at) == ("sleeping", 2, START + timedelta(seconds=35))


def test_an_expired_lease_waits_for_the_retry_delay(spark):
    rows = spawned(spark)
    soon = kept(fold.fold_state(rows, now=at(20), details=True))
    assert soon.first().state == "sleeping"
    assert soon.first().wake_at == START + timedelta(seconds=41)
    assert writes.claim(soon, at(40), 1, 1000).count() == 0
    assert writes.claim(soon, at(41), 1, 1000).count() == 1
    plain = fold.fold_state(spawned(spark, retry_kind=None), now=at(20), details=True).first()
    assert (plain.state, plain.attempt) == ("pending", 2)


def test_a_new_task_of_a_retry_has_the_old_parameters(spark):
    rows = spawned(spark)
    for second in (5, 50):
        state = state_of(rows)
        if second == 50:
            again = writes.claim_history(writes.claim(state, at(40), 1, 60_000))
            rows = rows.unionByName(again, allowMissingColumns=True)
            state = state_of(rows)
        rows = appended(rows, writes.fail(state, request(spark, rows, second, payload="{}")))
    state = state_of(rows)
    assert state.first().state == "failed"
    new = writes.retry(state, request(spark, rows, 60), spawn_new=True)
    rows = appended(rows, new)
    found = {r.task_id: r for r in fold.fold_state(rows, details=True).collect()}
    row = found[new.first().task_id]
    assert (row.state, row.params, row.headers) == ("pending", '{"a": 1}', {"trace": "t1"})


@pytest.mark.parametrize("timeout, emitted", [(None, 2), (None, 65), (60_000, 30), (60_000, 65)])
def test_an_event_wakes_its_task(spark, timeout, emitted):
    rows = spawned(spark)
    asked = request(spark, rows, 3, event_name="e").withColumn(
        "timeout_ms", F.lit(timeout).cast("long")
    )
    rows = appended(rows, writes.await_event(state_of(rows), asked))
    asleep = state_of(rows)
    assert writes.claim(asleep, at(20), 1, 1000).count() == 0
    events = spark.createDataFrame(
        [("q", "e", '{"value": 1}', START + timedelta(seconds=emitted), 1),
         ("q", "e", '{"value": 2}', START + timedelta(seconds=emitted + 1), 2)],
        "queue string, event_name string, payload string, emitted_at timestamp_ntz, seq long",
    )
    rows = kept(rows.unionByName(writes.wake(asleep, events, at(90)), allowMissingColumns=True))
    woken = state_of(rows)
    assert writes.wake(woken, events, at(90)).isEmpty() or (timeout and emitted == 65)
    claimed = kept(writes.claim(woken, at(90), 1, 1000))
    row = claimed.first()
    if timeout and emitted == 65:
        assert (row.wake_event, row.event_payload) == ("e", None)
    else:
        assert (row.wake_event, row.event_payload) == (None, '{"value": 1}')
    rows = more(rows, claimed)
    after = fold.fold_state(rows, details=True).first()
    assert (after.state, after.wake_event, after.event_payload) == (
        "running", row.wake_event, row.event_payload,
    )


def test_submit_routes_and_fills_options_from_the_catalog(spark):
    asked = spark.createDataFrame(
        [("1", None, "known", None), ("2", None, "raw", None), ("3", "other", "known", 9)],
        "request_id string, queue string, task_name string, max_attempts int",
    ).select("*", F.lit(None).cast("string").alias("idempotency_key"), at(0).alias("requested_at"))
    catalog = spark.createDataFrame(
        [("known", "jobs", 4, 7, None)],
        "task_name string, catalog_queue string, default_max_attempts int, "
        "default_max_delay_s long, default_max_duration_s long",
    )
    none = "queue string, idempotency_key string, task_id string, run_id string, attempt int"
    found = writes.submit(spark.createDataFrame([], none), asked, catalog=catalog)
    got = {r.request_id: r for r in found.collect()}
    assert (got["1"].queue, got["1"].max_attempts, got["1"].max_delay_s) == ("jobs", 4, 7)
    assert got["2"].problem == "queue_required" and got["3"].problem == "queue_mismatch"
    assert fold.fold_state(writes.spawn_history(found), details=True).first().max_delay_s == 7


def test_bad_rows_of_a_batch_fail_alone(spark):
    calls = spark.sparkContext.accumulator(0)

    @tasks.task(name="t", batch=True)
    def square(rows):
        calls.add(1)
        return (rows.params.astype(int) ** 2).astype(str)

    params = [str(i) if i not in (3, 77) else "x" for i in range(100)]
    runs = spark.createDataFrame(
        [(str(i), "t", 1, p) for i, p in enumerate(params)],
        "task_id string, task_name string, attempt int, params string",
    ).coalesce(1)
    found = {r.task_id: r for r in tasks.run_tasks(runs, tasks.Registry([square], "q")).collect()}
    assert {t for t, r in found.items() if r.state == "failed"} == {"3", "77"}
    assert found["3"].failure.name == "ValueError" and found["9"].result == "81"
    assert calls.value < 40


def test_batch_functions_must_answer_every_row(spark):
    @tasks.task(name="t", batch=True)
    def short(rows):
        return pd.Series([1] * (len(rows) - 1), dtype=object)

    runs = spark.createDataFrame(
        [("a", "t", 1, "1")], "task_id string, task_name string, attempt int, params string"
    )
    assert "0 results for 1 rows" in tasks.run_tasks(runs, tasks.Registry([short], "q")).first().failure.message


def test_rounds_wait_for_wake_times_and_limits(spark):
    calls = spark.sparkContext.accumulator(0)

    def never(params, context):
        calls.add(1)
        return tasks.Err("no")

    registry = tasks.Registry(
        [tasks.task(name="slow", max_attempts=3, retry=("fixed", 60.0, None, None))(never),
         tasks.task(name="over", max_duration_s=90, retry=("fixed", 60.0, None, None))(never),
         tasks.task(name="once", max_attempts=2)(never)], "q",
    )
    runs = spark.createDataFrame(
        [(n, n, None, START) for n in ("slow", "over", "once", "unknown")],
        "task_id string, task_name string, params string, spawned_at timestamp",
    )
    store, seen = new_path(spark, "rounds"), []
    for second in (0, 0, 59, 60, 100, 500):
        found = tasks.run_due(runs, registry, store, START + timedelta(seconds=second))
        seen.append({r.task_id: (r.state, r.attempt) for r in found.collect()} | {"calls": calls.value})
    assert seen[0] == {"slow": ("sleeping", 1), "over": ("sleeping", 1), "once": ("failed", 2),
                       "unknown": ("deferred", 0), "calls": 4}
    assert seen[1] == seen[0] and seen[2] == seen[0]
    assert seen[3]["slow"] == seen[3]["over"] == ("sleeping", 2) and seen[3]["calls"] == 6
    assert seen[4]["over"] == ("cancelled", 3) and seen[4]["slow"] == ("sleeping", 2)
    assert seen[5]["slow"] == ("failed", 3) and seen[5]["calls"] == 7
