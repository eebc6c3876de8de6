"""Literal scenarios of the task lifecycle, with the clock passed in."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.operators import history, retention, waits, writes

T0 = datetime(2026, 2, 3, 4, 5, 6)
QUEUE = "jobs"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def lit(seconds):
    return F.lit(at(seconds)).cast("timestamp")


def transitions(spark, *rows):
    """Rows of (task, op, seconds, options)."""
    data = []
    for seq, (task, op, seconds, *rest) in enumerate(rows):
        o = rest[0] if rest else {}
        wake = o.get("wake")
        data.append(
            (QUEUE, task, f"run-{task}", o.get("attempt", 1), o.get("max", 1), "echo", op,
             at(seconds), seq, o.get("payload"), None if wake is None else at(wake),
             o.get("lease"), o.get("event"))
        )
    return spark.createDataFrame(data, S.TRANSITIONS)


def requests(spark, *rows):
    """Rows of (task, seconds, options)."""
    names = "queue string, task_id string, ts timestamp, seq long, payload string"
    data = [(QUEUE, task, at(s), i, '{"n":1}') for i, (task, s) in enumerate(rows)]
    return spark.createDataFrame(data, names)


def states(spark, df, **options):
    return {r.task_id: r for r in history.fold_state(df, **options).collect()}


def appended(df, written):
    """History with the accepted rows of a bulk write."""
    new = written.where("accepted")
    return df.unionByName(new.select(*[c for c in df.columns if c in new.columns]), True)


def test_states_of_simple_histories(spark):
    df = transitions(
        spark,
        ("new", "spawn", 0),
        ("busy", "spawn", 0), ("busy", "claim", 1, {"lease": 60}),
        ("asleep", "spawn", 0), ("asleep", "claim", 1), ("asleep", "schedule", 2, {"wake": 62}),
        ("waiting", "spawn", 0), ("waiting", "claim", 2), ("waiting", "await_event", 3, {"wake": 63, "event": "e"}),
        ("done", "spawn", 0), ("done", "claim", 1), ("done", "complete", 2, {"payload": "7"}),
        ("lost", "spawn", 0), ("lost", "claim", 1), ("lost", "fail", 2, {"payload": "{}"}),
        ("stopped", "spawn", 0), ("stopped", "cancel", 2),
        ("orphan", "claim", 1),
    )
    found = states(spark, df)
    assert {k: r.state for k, r in found.items()} == {
        "new": "pending", "busy": "running", "asleep": "sleeping", "waiting": "sleeping",
        "done": "completed", "lost": "failed", "stopped": "cancelled",
    }
    assert found["done"].result == "7" and found["done"].failure is None
    assert found["lost"].failure == "{}" and found["lost"].result is None
    assert found["asleep"].wake_at == at(62) and found["waiting"].event_name == "e"
    assert states(spark, df, as_of=lit(1))["done"].state == "running"


def test_failure_with_attempts_left_starts_the_next_attempt(spark):
    df = transitions(
        spark,
        ("now", "spawn", 0, {"max": 3}), ("now", "claim", 1, {"max": 3}),
        ("now", "fail", 2, {"max": 3}),
        ("later", "spawn", 0, {"max": 3}), ("later", "claim", 1, {"max": 3}),
        ("later", "fail", 2, {"max": 3, "wake": 30}),
    )
    found = states(spark, df)
    assert (found["now"].state, found["now"].attempt) == ("pending", 2)
    assert (found["later"].state, found["later"].attempt) == ("sleeping", 2)
    assert found["later"].wake_at == at(30)


def test_first_terminal_row_wins_and_later_writes_are_rejected(spark):
    df = transitions(
        spark,
        ("a", "spawn", 0), ("a", "cancel", 5), ("a", "complete", 6, {"payload": "1"}),
        ("b", "spawn", 0), ("b", "claim", 1), ("b", "fail", 5), ("b", "fail", 6),
        ("b", "retry", 7, {"attempt": 2}), ("b", "claim", 8, {"attempt": 2, "max": 2}),
        ("c", "spawn", 0), ("c", "claim", 0), ("c", "complete", 1), ("c", "heartbeat", 2),
    )
    found = states(spark, df)
    assert found["a"].state == "cancelled" and found["a"].result is None
    assert found["b"].state == "running" and found["b"].attempt == 2
    assert found["b"].generation == 2
    rejected = history.rejected_writes(df).collect()
    assert {(r.task_id, r.op, r.code) for r in rejected} == {
        ("a", "complete", "AB001"), ("b", "fail", "AB002"), ("c", "heartbeat", None),
    }


def test_expired_lease_counts_as_a_failed_attempt(spark):
    df = transitions(
        spark,
        ("last", "spawn", 0), ("last", "claim", 1, {"lease": 60}),
        ("again", "spawn", 0, {"max": 2}), ("again", "claim", 1, {"max": 2, "lease": 60}),
        ("kept", "spawn", 0), ("kept", "claim", 1, {"lease": 60}),
        ("kept", "heartbeat", 50, {"lease": 90}),
    )
    found = states(spark, df, now=lit(61))
    assert (found["last"].state, found["last"].ended_at) == ("failed", at(61))
    assert (found["again"].state, found["again"].attempt) == ("pending", 2)
    assert (found["kept"].state, found["kept"].lease_until) == ("running", at(140))


def test_fail_retry_cancel_sequence(spark):
    df = transitions(spark, ("t", "spawn", 0), ("t", "claim", 1, {"lease": 60}))
    failing = requests(spark, ("t", 2)).withColumns(
        {
            "retry_at": F.lit(None).cast("timestamp"),
            "retry_kind": F.lit("fixed"),
            "retry_base_seconds": F.lit(0.0),
            "retry_factor": F.lit(None).cast("double"),
            "retry_max_seconds": F.lit(None).cast("double"),
        }
    )
    df = appended(df, writes.fail(history.fold_state(df), failing))
    snapshot = history.fold_state(df)
    assert snapshot.first().state == "failed"
    again = writes.fail(snapshot, failing).first()
    assert (again.accepted, again.reason, again.code) == (False, "failed", "AB002")

    refused = writes.retry(snapshot, requests(spark, ("t", 3)), max_attempts=1).first()
    assert refused.reason == "no_attempts_left"
    in_place = writes.retry(snapshot, requests(spark, ("t", 3)), max_attempts=2)
    row = in_place.first()
    assert (row.task_id, row.attempt, row.created) == ("t", 2, False)
    df = appended(df, in_place)
    assert history.fold_state(df).first().state == "pending"

    fresh = writes.retry(snapshot, requests(spark, ("t", 4)), spawn_new=True)
    new = fresh.first()
    assert new.task_id != "t" and new.attempt == 1 and new.created
    assert new == fresh.first()
    df = appended(df, fresh)
    cancelled = writes.cancel(history.fold_state(df), requests(spark, (new.task_id, 5)))
    df = appended(df, cancelled)
    snapshot = history.fold_state(df)
    assert {r.task_id: r.state for r in snapshot.collect()}[new.task_id] == "cancelled"
    beat = requests(spark, (new.task_id, 6)).withColumn("lease_ms", F.lit(30_000))
    assert writes.extend_lease(snapshot, beat).first().code == "AB001"


def test_only_the_first_request_of_a_batch_ends_a_run(spark):
    df = transitions(spark, ("t", "spawn", 0), ("t", "claim", 1), ("idle", "spawn", 0))
    asked = requests(spark, ("t", 3), ("t", 2), ("idle", 2), ("nobody", 2))
    done = writes.complete(history.fold_state(df), asked).collect()
    assert {(r.task_id, r.ts): r.reason for r in done} == {
        ("t", at(2)): None, ("t", at(3)): "superseded", ("idle", at(2)): "not_running",
        ("nobody", at(2)): "unknown_task",
    }


def test_schedule_times(spark):
    df = transitions(spark, ("t", "spawn", 0), ("t", "claim", 1))
    snapshot = history.fold_state(df)
    relative = requests(spark, ("t", 2)).withColumn("delay_ms", F.lit(1_500))
    assert writes.schedule_after(snapshot, relative).first().wake_at == at(3.5)
    absolute = requests(spark, ("t", 2)).withColumn("wake_at", lit(60))
    slept = appended(df, writes.schedule(snapshot, absolute))
    rows = history.fold_state(slept)
    assert history.due_batch(rows, lit(59), 5).count() == 0
    assert history.due_batch(rows, lit(60), 5).first().task_id == "t"


def test_lease_milliseconds_round_up(spark):
    df = transitions(spark, ("t", "spawn", 0), ("t", "claim", 1))
    beat = requests(spark, ("t", 2)).withColumn("lease_ms", F.lit(1_500))
    assert writes.extend_lease(history.fold_state(df), beat).first().lease_s == 2


def test_event_wait_first_event_and_timeout(spark):
    wait = spark.createDataFrame(
        [
            ("w1", QUEUE, "e", at(0), 60),
            ("w2", QUEUE, "none", at(0), 10),
            ("w3", QUEUE, "none", at(0), None),
            ("w4", QUEUE, "edge", at(0), 10),
            ("early", QUEUE, "before", at(0), 10),
            ("future", QUEUE, "e", at(900), 10),
        ],
        "wait_id string, queue string, event_name string, wait_ts timestamp, timeout_s long",
    )
    events = spark.createDataFrame(
        [
            (QUEUE, "e", '{"value":2}', at(31), 2),
            (QUEUE, "e", '{"value":1}', at(30), 1),
            (QUEUE, "edge", "1", at(10), 3),
            (QUEUE, "before", None, at(-100), 4),
            ("other", "none", "1", at(1), 5),
        ],
        S.EVENTS,
    )
    at_20 = {r.wait_id: r for r in waits.resolve_waits(wait, events, lit(20)).collect()}
    assert {k: r.status for k, r in at_20.items()} == {
        "w1": "sleeping", "w2": "timed_out", "w3": "sleeping", "w4": "timed_out",
        "early": "resolved",
    }
    assert at_20["early"].payload is None and at_20["early"].resolved_at == at(0)
    assert at_20["w2"].resolved_at == at(10)
    at_50 = {r.wait_id: r for r in waits.resolve_waits(wait, events, lit(50)).collect()}
    assert at_50["w1"].status == "resolved" and at_50["w1"].payload == '{"value":1}'
    assert at_50["w1"].resolved_at == at(30)


def test_idempotent_spawn_and_hook(spark):
    names = "request_id string, queue string, idempotency_key string, task_name string"
    asked = spark.createDataFrame(
        [
            ("r1", QUEUE, "k", "echo", at(0)), ("r2", QUEUE, "k", "ignored", at(1)),
            ("r3", QUEUE, None, "echo", at(2)), ("r4", QUEUE, None, "echo", at(3)),
            ("r5", "", "x", "echo", at(4)), ("r6", QUEUE, "y", "  ", at(5)),
        ],
        names + ", requested_at timestamp",
    )
    empty = spark.createDataFrame(
        [], "queue string, idempotency_key string, task_id string, run_id string, attempt int"
    )
    first = {r.request_id: r for r in writes.submit(empty, asked).collect()}
    assert first["r1"].created and not first["r2"].created
    assert first["r1"].task_id == first["r2"].task_id
    assert first["r3"].task_id != first["r4"].task_id
    assert len(first["r1"].task_id) == 32
    assert first["r5"].problem == "empty" and first["r6"].problem == "empty"
    known = writes.submit(empty, asked).where("created")
    second = {r.request_id: r for r in writes.submit(known, asked).collect()}
    assert not second["r1"].created and second["r1"].task_id == first["r1"].task_id
    assert second["r3"].created

    def to_other(df):
        return df.withColumn("queue", F.when(F.col("request_id") == "r3", "").otherwise("other"))

    hooked = {r.request_id: r for r in writes.submit(empty, asked, hook=to_other).collect()}
    assert hooked["r1"].queue == "other" and hooked["r3"].problem == "empty"


def test_committed_null_is_done(spark):
    steps = spark.createDataFrame(
        [("t", "repeat"), ("t", "repeat#2"), ("t", "shape"), ("t", "new")],
        "task_id string, checkpoint_name string",
    )
    checkpoints = spark.createDataFrame(
        [
            ("t", "repeat", None, "committed", "r1", at(1)),
            ("t", "repeat#2", '{"occurrence":2}', "committed", "r1", at(1)),
            ("t", "shape", "[null,true,3]", "committed", "r1", at(1)),
            ("t", "shape", "0", "pending", "r2", at(2)),
            ("t", "new", "0", "pending", "r2", at(2)),
        ],
        S.CHECKPOINTS,
    )
    done = {r.checkpoint_name: r for r in history.replay(steps, checkpoints).collect()}
    assert done["repeat"].done and done["repeat"].value is None
    assert done["shape"].value == "[null,true,3]"
    assert not done["new"].done
    assert [r.checkpoint_name for r in history.remaining(steps, checkpoints).collect()] == ["new"]


def test_cleanup_removes_old_tasks_and_events(spark):
    df = transitions(
        spark, ("t", "spawn", 0), ("t", "claim", 1), ("t", "complete", 2), ("live", "spawn", 0)
    )
    snapshot = history.fold_state(df)
    events = spark.createDataFrame([(QUEUE, "e", "1", at(2), 1)], S.EVENTS)
    tasks = retention.cleanup_tasks(snapshot, lit(7_200), 3_600, limit=10)
    old_events = retention.cleanup_events(events, lit(7_200), 3_600, limit=10)
    counts = retention.cleanup_counts(tasks, old_events).first()
    assert (counts.tasks_deleted, counts.events_deleted) == (1, 1)
    left = retention.survivors(snapshot, tasks, ["queue", "task_id"])
    wanted = spark.createDataFrame([(QUEUE, "t")], "queue string, task_id string")
    assert waits.fetch_results(left, wanted).first().state is None
    assert [r.task_id for r in left.collect()] == ["live"]
    assert retention.cleanup_tasks(snapshot, lit(3_601), 3_600, limit=10).count() == 0


def test_policy_update_keeps_omitted_fields(spark):
    current = spark.createDataFrame(
        [("q", "unpartitioned", "35 days", "2 days", "12345 seconds", 77, "empty", "45 days")],
        S.POLICIES,
    )
    update = spark.createDataFrame(
        [("q", None, None, None, "4321 seconds", 12, None, None)], S.POLICIES
    )
    row = retention.upsert_policies(current, update).first()
    assert (row.cleanup_ttl, row.cleanup_limit, row.detach_mode) == ("4321 seconds", 12, "empty")
    seconds = retention.interval_seconds(F.lit(row.cleanup_ttl), lit(0))
    assert spark.range(1).select(seconds).first()[0] == 4321.0


@pytest.mark.parametrize(
    "queue, override, status",
    [("q1", None, "completed"), ("q1", "q1", "completed"), ("q1", "q2", "queue_mismatch")],
)
def test_results_by_reference(spark, queue, override, status):
    snapshot = spark.createDataFrame(
        [("q1", "t", "completed", '{"answer":42}', None)],
        "queue string, task_id string, state string, result string, failure string",
    )
    reference = spark.createDataFrame(
        [(queue, "t", override)], "queue string, task_id string, queue_override string"
    )
    assert waits.results_by_reference(reference, snapshot).first().status == status


def test_child_results(spark):
    snapshot = spark.createDataFrame(
        [
            ("children", "c1", "completed", '{"answer":42}', None),
            ("children", "c2", "running", None, None),
        ],
        "queue string, task_id string, state string, result string, failure string",
    )
    parents = spark.createDataFrame(
        [
            ("jobs", "p1", "children", "c1"), ("children", "p2", "children", "c1"),
            ("jobs", "p3", "children", "c2"), ("jobs", "p4", "children", "c9"),
        ],
        "queue string, task_id string, child_queue string, child_id string",
    )
    found = {r.task_id: r for r in waits.child_results(parents, snapshot).collect()}
    assert {k: r.status for k, r in found.items()} == {
        "p1": "completed", "p2": "same_queue", "p3": "waiting", "p4": "unknown",
    }
    assert found["p1"].result == '{"answer":42}' and found["p2"].result is None
