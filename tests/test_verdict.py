"""Cases that a review of the history loop, audits and names asked for."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.payload import is_json
from tallyfold.functions.timing import after, retry_delay
from tallyfold.operators import catalog, history, steps, tasks, writes
from tallyfold.plans import top_per_group
from tallyfold.sources.tables import read_history, write_history
from tallyfold.streaming.state import batch_before, write_batch

START = datetime(2024, 1, 1)
HISTORY = (
    "queue string, task_id string, run_id string, attempt int, max_attempts int, task_name string, "
    "op string, ts timestamp_ntz, seq long, payload string, wake_at timestamp_ntz, lease_s long, "
    "event_name string"
)


def rows(spark, *ops, task="t"):
    """History of one task: (op, hours, extra fields)."""
    made = []
    for seq, (op, hours, *extra) in enumerate(ops):
        more = extra[0] if extra else {}
        made.append(
            ("q", task, "r", more.get("attempt", 1), 3, "n", op, START + timedelta(hours=hours), seq,
             more.get("payload"), more.get("wake_at"), more.get("lease_s"), more.get("event_name"))
        )
    return spark.createDataFrame(made, HISTORY)


def at(hours):
    return F.lit(START + timedelta(hours=hours)).cast("timestamp_ntz")


def test_pending_tasks_and_expired_leases_are_claimed(spark):
    table = rows(spark, ("spawn", 0), task="new").union(
        rows(spark, ("spawn", 0), ("claim", 1, {"lease_s": 10}), task="expired")
    ).union(rows(spark, ("spawn", 0), ("claim", 1), ("schedule", 2, {"wake_at": START + timedelta(hours=3)}), task="due")).union(
        rows(spark, ("spawn", 0), ("claim", 1), ("schedule", 2, {"wake_at": START + timedelta(hours=30)}), task="later")
    )
    state = history.fold_state(table, now=at(5))
    claimed = writes.claim(state, at(5), 10, 1000)
    assert {r.task_id for r in claimed.collect()} == {"new", "expired", "due"}


def test_a_checkpoint_without_a_lease_keeps_the_lease(spark):
    table = rows(spark, ("spawn", 0), ("claim", 1, {"lease_s": 10}), ("checkpoint", 25))
    assert history.fold_state(table).first().lease_until == START + timedelta(hours=1, seconds=10)
    assert history.fold_state(table, now=at(26)).first().state == "pending"


def test_a_heartbeat_does_not_wake_a_sleeper(spark):
    table = rows(spark, ("spawn", 0), ("claim", 1), ("schedule", 2, {"wake_at": START + timedelta(hours=9)}), ("heartbeat", 3, {"lease_s": 60}))
    row = history.fold_state(table).first()
    assert (row.state, row.wake_at) == ("sleeping", START + timedelta(hours=9))


def test_payloads_shuffled_by_the_fold_are_those_of_ending_rows(spark, tmp_path):
    rows(spark, ("spawn", 0, {"payload": "{}"}), ("claim", 1), ("complete", 1, {"payload": "7"})).write.parquet(str(tmp_path / "h"))
    table = spark.read.parquet(str(tmp_path / "h"))
    assert history.fold_state(table).first().result == "7"
    plan = history.fold_state(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan.split("payload")[0].rsplit("\n", 1)[-1] or "THEN payload" in plan


def test_long_delays_do_not_overflow(spark):
    frame = spark.range(1).select(
        *(after(at(0), retry_delay(F.lit("exponential"), F.lit(b), F.lit(10.0), F.lit(None), F.lit(n))).alias(f"d{n}{int(b)}")
          for b in (0.0, 30.0) for n in (1, 60, 2000))
    )
    row = frame.first()
    assert row.d10 == row.d600 == row.d20000 == START and row.d130 == START + timedelta(seconds=30)
    assert row.d6030.year > 5000 and row.d6030 == row.d200030


def test_every_checkpoint_and_retry_request_gets_an_answer(spark):
    state = history.fold_state(rows(spark, ("spawn", 0), ("claim", 1, {"lease_s": 60})))
    asked = spark.createDataFrame(
        [("q", "t", START, s, name, "1", 1000) for s, name in enumerate(["a", "b", "b"])],
        "queue string, task_id string, ts timestamp_ntz, seq long, checkpoint_name string, payload string, lease_ms long",
    )
    done = spark.createDataFrame([("t", "a", "committed")], "task_id string, checkpoint_name string, status string")
    found = {r.seq: r.reason for r in writes.write_checkpoints(state, asked, done).collect()}
    assert found == {0: "already_committed", 1: None, 2: "superseded"}
    failed = history.fold_state(rows(spark, ("spawn", 0), ("claim", 1), ("fail", 2, {"attempt": 3})))
    again = {r.seq: r.reason for r in writes.retry(failed, asked, max_attempts=9).collect()}
    assert again == {0: None, 1: "superseded", 2: "superseded"}


@pytest.mark.parametrize("text, valid", [('{"a":1,"a":2}', True), ('{"a":1', False), ("1", True), ("", False)])
def test_valid_json(spark, text, valid):
    assert spark.createDataFrame([(text,)], "t string").select(is_json(F.col("t"))).first()[0] is valid


def test_step_names_with_long_numbers_and_newlines(spark):
    names = ["x#99999999999999999999", "x", "x#2\n", "x", "a\nb", "a\nb", "a\nb#2"]
    calls = spark.createDataFrame([("t", n, i) for i, n in enumerate(names)], "task_id string, name string, seq long")
    found = {r.seq: (r.checkpoint_name, r.accepted) for r in steps.allocate_names(calls, ["task_id"], ["seq"]).collect()}
    taken = [name for name, ok in found.values() if ok]
    assert len(taken) == len(set(taken))
    assert found[0] == (names[0], True) and found[2] == ("x#2\n", True) and found[3] == ("x#2", True)
    assert found[5] == ("a\nb#2", True) and found[6][1] is False


def test_one_answer_for_a_name_in_two_queues(spark):
    names = spark.createDataFrame(
        [("n", "a", 2, 10, 20), ("n", "b", 3, 30, 40), ("m", None, 4, 50, 60)],
        "task_name string, catalog_queue string, default_max_attempts int, default_max_duration_s long, default_max_delay_s long",
    )
    asked = spark.createDataFrame(
        [(1, "n", "a"), (2, "n", "b"), (3, "n", "c"), (4, "n", None), (5, "m", None), (6, "z", None), (7, "z", "q")],
        "request_id int, task_name string, queue string",
    ).selectExpr("*", "cast(null as int) max_attempts", "cast(null as bigint) max_duration_s", "cast(null as bigint) max_delay_s")
    for client, four in (("b", "b"), ("other", None)):
        found = {r.request_id: (r.routed_queue, r.reason) for r in catalog.route(asked, names, client).collect()}
        assert len(found) == 7 == catalog.route(asked, names, client).count()
        assert found[1] == ("a", None) and found[2] == ("b", None) and found[3] == (None, "queue_mismatch")
        assert found[4] == (four, None if four else "queue_required")
        assert found[5] == (client, None) and found[6] == (None, "queue_required") and found[7] == ("q", None)
    resolved = {r.request_id: r for r in catalog.resolve_options(asked, names, default_queue="b").collect()}
    assert resolved[1].resolved_max_attempts == 2 and resolved[4].resolved_max_delay_s == 40
    assert resolved[6].resolved_max_attempts == S.DEFAULT_MAX_ATTEMPTS


def test_history_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "history")
    table = rows(spark, ("spawn", 0), ("claim", 30), ("complete", 60))
    typed = table.withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "wake_at")})
    write_history(typed, path, storage_mode="partitioned")
    limit = F.lit(START + timedelta(hours=31)).cast("timestamp")
    found = read_history(spark, path, "transitions", as_of=limit, storage_mode="partitioned")
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


@pytest.mark.parametrize("n", [25, 1001, 60_000])
def test_top_rows_are_cut_before_the_shuffle(spark, n, tmp_path):
    spark.range(10).selectExpr("cast(id % 2 as string) queue", "id").write.parquet(str(tmp_path / "t"))
    top = top_per_group(spark.read.parquet(str(tmp_path / "t")), ["queue"], ["id"], n)
    assert "Partial" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 10


def test_a_completed_attempt_is_not_run_again(spark, tmp_path):
    called = str(tmp_path / "calls")
    store = str(tmp_path / "store")
    spark.createDataFrame(
        [("t", "completed", "1", None, 1), ("t", "failed", None, None, 1)],
        tasks.ATTEMPTS,
    ).write.partitionBy("attempt").parquet(store)

    @tasks.task(name="n", max_attempts=3)
    def again(params, context):
        with open(called, "a") as file:
            file.write("x")
        return tasks.Ok(2)

    registry = tasks.Registry([again], "q")
    runs = spark.createDataFrame([("t", "n", "{}")], "task_id string, task_name string, params string")
    row = tasks.run_with_retries(runs, registry, store).first()
    assert row.state == "completed" and row.attempt == 1
    assert not (tmp_path / "calls").exists()


def test_state_of_a_missing_batch_is_an_error(spark, tmp_path):
    path, schema = str(tmp_path / "state"), S.struct("name string")
    assert batch_before(spark, path, 0, schema).count() == 0
    write_batch(spark.createDataFrame([("a",)], schema), path, 0)
    assert batch_before(spark, path, 1, schema).count() == 1
    with pytest.raises(FileNotFoundError):
        batch_before(spark, path, 3, schema)
