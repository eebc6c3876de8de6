"""Bulk writes: later events become requests against the state folded up to the cut."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.operators import writes
from tallyfold.queries.history import fold_sql, now, snapshot
from tallyfold.queries.views import NOW, VIEWS, sql, view
from tallyfold.session import new_path
from tallyfold.sources.keys import KeyTable
from tallyfold.sources.tables import read_history, write_history

AT_NOW = f"TIMESTAMP '{NOW}'"
SHOWN = [
    "queue", "task_id", "run_id", "attempt", "op", "ts", "seq", "payload", "wake_at",
    "lease_s", "event_name", "accepted", "reason", "code",
]


def _state(spark, sf):
    return snapshot(spark, sf, as_of=now())


def _requests(spark, sf, event_type):
    later = view(spark, sf, "task_requests").where(F.col("ts") > now())
    return later.where(F.col("event_type") == event_type).drop("event_type")


def completed(spark, sf):
    return writes.complete(_state(spark, sf), _requests(spark, sf, "purchase")).select(*SHOWN)


def failed(spark, sf):
    requests = _requests(spark, sf, "error").select(
        "*",
        F.when(F.col("milliseconds") > 50_000, F.col("ts") + F.expr("interval 5 minutes")).alias(
            "retry_at"
        ),
        F.when(F.col("milliseconds") > 5_000, "exponential").otherwise("fixed").alias("retry_kind"),
        F.lit(30.0).alias("retry_base_seconds"),
        F.lit(3.0).alias("retry_factor"),
        F.lit(80.0).alias("retry_max_seconds"),
    )
    return writes.fail(_state(spark, sf), requests).select(*SHOWN)


def scheduled(spark, sf):
    requests = _requests(spark, sf, "click").withColumn(
        "wake_at", F.col("ts") + F.expr("interval 1 day")
    )
    return writes.schedule(_state(spark, sf), requests).select(*SHOWN)


def scheduled_after(spark, sf):
    requests = _requests(spark, sf, "click").withColumn("delay_ms", F.col("milliseconds"))
    return writes.schedule_after(_state(spark, sf), requests).select(*SHOWN)


def awaited(spark, sf):
    requests = _requests(spark, sf, "signup").select(
        "*",
        F.concat(F.lit("ready "), "payload").alias("event_name"),
        F.col("milliseconds").alias("timeout_ms"),
    )
    return writes.await_event(_state(spark, sf), requests).select(*SHOWN)


def extended(spark, sf):
    requests = _requests(spark, sf, "view").withColumn("lease_ms", F.col("milliseconds"))
    return writes.extend_lease(_state(spark, sf), requests).select(*SHOWN)


def _checkpoint_requests(spark, sf):
    return _requests(spark, sf, "view").select(
        "*",
        F.concat(F.lit("view-"), (F.col("seq") % 20).cast("string")).alias("checkpoint_name"),
        F.col("milliseconds").alias("lease_ms"),
    )


def checkpointed(spark, sf):
    done = view(spark, sf, "checkpoints").where(F.col("updated_at") <= now())
    requests = _checkpoint_requests(spark, sf)
    return writes.write_checkpoints(_state(spark, sf), requests, done).select(*SHOWN)


def checkpointed_by_key(spark, sf):
    """The same, with the committed checkpoints found in a bucketed table of three batches."""
    done = view(spark, sf, "checkpoints").where(F.col("updated_at") <= now())
    steps = done.where(F.col("status") == "committed").select("task_id", "checkpoint_name").distinct()
    schema = S.struct("task_id string, checkpoint_name string, status string")
    stored = steps.withColumn("status", F.lit("committed"))
    table = KeyTable(
        spark, new_path(spark, "committed"), schema, ["task_id", "checkpoint_name"], buckets=16
    )
    for part in range(3):
        table.append(stored.where(F.pmod(F.xxhash64("checkpoint_name"), F.lit(3)) == part), part)
    requests = _checkpoint_requests(spark, sf)
    found = table.find(requests, 2)
    return writes.write_checkpoints(_state(spark, sf), requests, found).select(*SHOWN)


def cancelled(spark, sf):
    return writes.cancel(_state(spark, sf), _requests(spark, sf, "error")).select(*SHOWN)


def claimed(spark, sf):
    """Claim rows for the first due runs of every queue."""
    return writes.claim(view(spark, sf, "runs"), now(), 40, 1_500)


def _retried(spark, sf, **options):
    return writes.retry(_state(spark, sf), _requests(spark, sf, "signup"), **options)


def retried(spark, sf):
    return _retried(spark, sf, max_attempts=5)


def respawned(spark, sf):
    return _retried(spark, sf, spawn_new=True)


def emitted_events(spark, sf):
    events = view(spark, sf, "signals").withColumn(
        "event_name", F.when(F.col("seq") % 3 == 0, F.lit("  ")).otherwise(F.col("event_name"))
    )
    fine, refused = writes.emit(events)
    return fine.unionByName(refused, allowMissingColumns=True)


def stored_history(spark, sf):
    """Write the transitions by queue and day, and read one queue back up to the cut."""
    path = new_path(spark, "transitions")
    rows = view(spark, sf, "transitions").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("ts", "wake_at")}
    )
    write_history(rows, path, storage_mode="partitioned")
    stored = read_history(
        spark, path, "transitions", queue="q2", as_of=now().cast("timestamp")
    )
    shown = ["queue", "task_id", "op", "ts", "seq", "payload", "wake_at"]
    return stored.select(*shown).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("ts", "wake_at")}
    )


def _write_sql(op, event_type, *, once=True, running=True, payload="NULL", wake_at="NULL",
               lease="NULL", event="NULL", source="later", refused="NULL"):
    not_running = "WHEN state <> 'running' THEN 'not_running'" if running else ""
    superseded = (
        "CASE WHEN first_reason IS NULL AND row_number() OVER ("
        "PARTITION BY queue, task_id, first_reason ORDER BY ts, seq) > 1 "
        "THEN 'superseded' ELSE first_reason END"
    )
    return fold_sql(
        f""", later AS (SELECT * FROM task_requests WHERE ts > $now
                        AND event_type = '{event_type}'),
          taken AS ({source if source != "later" else "SELECT * FROM later"}),
          judged AS (
            SELECT r.*, s.run_id, s.attempt, s.max_attempts, s.state,
                   CASE WHEN state IS NULL THEN 'unknown_task'
                        WHEN state IN ('completed', 'failed', 'cancelled') THEN state
                        {not_running} END AS first_reason
            FROM taken r LEFT JOIN snapshot s USING (queue, task_id)),
          final AS (SELECT *, {superseded if once else f"coalesce(first_reason, {refused})"} AS reason FROM judged)
          SELECT queue, task_id, run_id, attempt, '{op}' AS op, ts, seq,
                 CAST({payload} AS VARCHAR) AS payload, CAST({wake_at} AS TIMESTAMP) AS wake_at,
                 CAST({lease} AS BIGINT) AS lease_s, CAST({event} AS VARCHAR) AS event_name,
                 reason IS NULL AS accepted, reason,
                 CASE state WHEN 'cancelled' THEN 'AB001' WHEN 'failed' THEN 'AB002' END AS code
          FROM final""",
        "task_requests",
        where=f"WHERE ts <= {AT_NOW}",
    )


UP = "(milliseconds + 999) // 1000"
FAIL_WAKE = """CASE WHEN attempt < max_attempts THEN
    CASE WHEN milliseconds > 50000 THEN ts + INTERVAL 5 MINUTE
         ELSE ts + to_microseconds(CAST(1000000 * CASE WHEN milliseconds > 5000
                THEN least(30 * pow(3, attempt - 1), 80) ELSE 30 END AS BIGINT)) END END"""
NEW_CHECKPOINTS = f"""
    SELECT l.*, concat('view-', CAST(seq % 20 AS VARCHAR)) AS checkpoint_name,
           CASE WHEN EXISTS (
                  SELECT 1 FROM ({VIEWS["checkpoints"]}) c
                  WHERE c.status = 'committed' AND c.updated_at <= $now AND c.task_id = l.task_id
                    AND c.checkpoint_name = concat('view-', CAST(l.seq % 20 AS VARCHAR)))
                THEN 'already_committed'
                WHEN row_number() OVER (PARTITION BY task_id, seq % 20 ORDER BY ts, seq) > 1
                THEN 'superseded' END AS refused
    FROM later l"""


def _retry_sql(spawn_new):
    limit = "max_attempts" if spawn_new else "5"
    next_attempt = "1" if spawn_new else "attempt + 1"
    new_task = "md5(concat(task_id, chr(1), CAST(attempt AS VARCHAR)))" if spawn_new else "task_id"
    key = "coalesce(new_task, chr(0))"
    number = "coalesce(CAST(next_attempt AS VARCHAR), chr(0))"
    if spawn_new:
        new_task = new_task.replace(
            "CAST(attempt AS VARCHAR)", "coalesce(CAST(attempt AS VARCHAR), chr(0))"
        )
    return fold_sql(
        f""", asked AS (
            SELECT queue, task_id, ts, seq, row_number() OVER (PARTITION BY queue, task_id
                                                               ORDER BY ts, seq) > 1 AS late
            FROM task_requests WHERE ts > $now AND event_type = 'signup'),
          joined AS (
            SELECT r.*, s.attempt, s.max_attempts, s.task_name, s.state,
                   CAST({next_attempt} AS INTEGER) AS next_attempt, {new_task} AS new_task
            FROM asked r LEFT JOIN snapshot s USING (queue, task_id)),
          judged AS (
            SELECT *, CASE WHEN state IS NULL THEN 'unknown_task'
                           WHEN state <> 'failed' THEN concat('not_failed:', state)
                           WHEN {limit} < next_attempt THEN 'no_attempts_left'
                           WHEN late THEN 'superseded' END AS reason
            FROM joined)
          SELECT queue, task_id AS source_task_id, new_task AS task_id,
                 md5(concat({key}, chr(1), {number})) AS run_id, next_attempt AS attempt,
                 CAST({limit} AS INTEGER) AS max_attempts, task_name,
                 '{"spawn" if spawn_new else "retry"}' AS op, ts, seq,
                 reason IS NULL AS accepted, reason, {str(spawn_new).lower()} AS created
          FROM judged""",
        "task_requests",
        where=f"WHERE ts <= {AT_NOW}",
    )


QUERIES = {
    "complete_runs": (completed, _write_sql("complete", "purchase", payload="payload")),
    "fail_runs": (failed, _write_sql("fail", "error", payload="payload", wake_at=FAIL_WAKE)),
    "schedule_runs": (
        scheduled,
        _write_sql("schedule", "click", wake_at="ts + INTERVAL 1 DAY"),
    ),
    "schedule_runs_after": (
        scheduled_after,
        _write_sql("schedule", "click", wake_at="ts + to_milliseconds(milliseconds)"),
    ),
    "await_events": (
        awaited,
        _write_sql(
            "await_event",
            "signup",
            wake_at=f"ts + to_seconds({UP})",
            event="concat('ready ', payload)",
        ),
    ),
    "extend_leases": (extended, _write_sql("heartbeat", "view", once=False, lease=UP)),
    "write_checkpoints": (
        checkpointed,
        _write_sql(
            "checkpoint",
            "view",
            once=False,
            payload="payload",
            lease=UP,
            event="checkpoint_name",
            source=NEW_CHECKPOINTS,
            refused="refused",
        ),
    ),
    "checkpoints_by_key": (
        checkpointed_by_key,
        _write_sql(
            "checkpoint",
            "view",
            once=False,
            payload="payload",
            lease=UP,
            event="checkpoint_name",
            source=NEW_CHECKPOINTS,
            refused="refused",
        ),
    ),
    "cancel_tasks": (cancelled, _write_sql("cancel", "error", running=False)),
    "claim_runs": (
        claimed,
        sql(
            "runs",
            body="""SELECT run_id, queue, started_at, ended_at, 'claim' AS op, $now AS ts,
                      CAST(row_number() OVER (PARTITION BY queue ORDER BY wake_at NULLS FIRST, run_id)
                           AS BIGINT) AS seq, CAST(2 AS BIGINT) AS lease_s
                    FROM runs WHERE wake_at <= $now OR (wake_at IS NULL AND state = 'pending')
                    QUALIFY seq <= 40""",
            now=AT_NOW,
        ),
    ),
    "retry_tasks": (retried, _retry_sql(False)),
    "retry_as_new_tasks": (respawned, _retry_sql(True)),
    "emit_events": (
        emitted_events,
        sql(
            "signals",
            body="""SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN '  ' ELSE event_name END
                                      AS event_name),
                      CASE WHEN seq % 3 = 0 THEN 'empty' END AS problem FROM signals""",
        ),
    ),
    "stored_history": (
        stored_history,
        sql(
            "transitions",
            body="""SELECT queue, task_id, op, ts, seq, payload, wake_at FROM transitions
                    WHERE queue = 'q2' AND ts <= $now""",
            now=AT_NOW,
        ),
    ),
}
