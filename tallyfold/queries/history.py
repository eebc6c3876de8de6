"""State, attempts, steps and deduplication over the event history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import history, steps, writes
from tallyfold.queries.views import NOW, sql, view
from tallyfold.session import written

ENDS = "(op IN ('complete', 'cancel') OR (op = 'fail' AND attempt >= coalesce(max_attempts, 5)))"
GENERATIONS = """, generations AS (
    SELECT *, CAST(sum(CASE WHEN op IN ('spawn', 'retry') THEN 1 ELSE 0 END)
                   OVER (PARTITION BY queue, task_id ORDER BY ts, seq) AS BIGINT) AS generation,
           op NOT IN ('complete', 'fail', 'schedule', 'await_event') OR coalesce(
             last_value(CASE WHEN op NOT IN ('heartbeat', 'checkpoint') THEN op END IGNORE NULLS)
               OVER (PARTITION BY queue, task_id ORDER BY ts, seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'claim', false) AS legal
    FROM transitions $where)"""
FOLD = (
    GENERATIONS
    + f""", newest AS (
    SELECT *, {ENDS} AS ends FROM generations WHERE generation >= 1 AND legal
    QUALIFY generation = max(generation) OVER (PARTITION BY queue, task_id)),
  chosen AS (
    SELECT * REPLACE (coalesce(max_attempts, 5) AS max_attempts),
           min(CASE WHEN op = 'claim' THEN ts END) OVER (PARTITION BY queue, task_id)
                  AS started_at,
           arg_max(ts + to_seconds(lease_s), (ts, seq)) FILTER (lease_s IS NOT NULL)
                  OVER (PARTITION BY queue, task_id) AS lease_end,
           max(CASE WHEN op IN ('heartbeat', 'checkpoint') THEN ts END)
                  OVER (PARTITION BY queue, task_id) AS extended_at
    FROM newest
    QUALIFY row_number() OVER (
        PARTITION BY queue, task_id
        ORDER BY ends DESC, op IN ('heartbeat', 'checkpoint'), CASE WHEN ends THEN epoch_us(ts) ELSE -epoch_us(ts) END,
                 CASE WHEN ends THEN seq ELSE -seq END) = 1),
  stated AS (
    SELECT *, CASE WHEN op = 'complete' THEN 'completed' WHEN op = 'cancel' THEN 'cancelled'
                   WHEN op = 'fail' AND ends THEN 'failed'
                   WHEN op = 'fail' AND wake_at > ts THEN 'sleeping'
                   WHEN op = 'claim' THEN 'running'
                   WHEN op IN ('schedule', 'await_event') THEN 'sleeping'
                   ELSE 'pending' END AS state
    FROM chosen),
  snapshot AS (
    SELECT queue, task_id, run_id, task_name, generation,
           CASE WHEN op = 'fail' AND NOT ends THEN attempt + 1 ELSE attempt END AS attempt,
           max_attempts, state,
           CASE WHEN op = 'complete' THEN payload END AS result,
           CASE WHEN op = 'fail' AND ends THEN payload END AS failure,
           started_at, CASE WHEN ends THEN ts END AS ended_at,
           CASE WHEN state = 'sleeping' THEN wake_at END AS wake_at,
           CASE WHEN state = 'sleeping' THEN event_name END AS event_name,
           CASE WHEN state = 'running' THEN lease_end END AS lease_until,
           CASE WHEN state = 'running' THEN greatest(ts, extended_at) ELSE ts END AS updated_at
    FROM stated)"""
)


def fold_sql(body: str, *extra: str, where: str = "") -> str:
    return sql("transitions", *extra, body=FOLD + body, where=where, now=f"TIMESTAMP '{NOW}'")


def woken_sql(body: str) -> str:
    """``body`` over the snapshot of the waiting history and the waits whose event arrived."""
    lasting = """, lasting AS (SELECT * REPLACE (CASE WHEN op = 'await_event' AND seq % 4 = 0
                   THEN NULL ELSE wake_at END AS wake_at) FROM transitions WHERE ts <= $now)"""
    woken = """, firsts AS (
        SELECT queue, event_name, arg_min(payload, (emitted_at, seq)) AS payload,
               min(emitted_at) AS emitted_at
        FROM announced WHERE emitted_at <= $now GROUP BY ALL),
      woken AS (
        SELECT s.*, f.payload, greatest(updated_at, emitted_at) AS ts
        FROM snapshot s JOIN firsts f USING (queue, event_name)
        WHERE state = 'sleeping' AND (wake_at IS NULL OR emitted_at < wake_at)) """
    folded = FOLD.replace("FROM transitions $where", "FROM lasting")
    return sql("transitions", "announced", body=lasting + folded + woken + body,
               now=f"TIMESTAMP '{NOW}'")


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def snapshot(spark, sf, as_of=None):
    return history.fold_state(view(spark, sf, "transitions"), as_of=as_of)


def first_events(spark, sf):
    return history.first_events(view(spark, sf, "signals"))


def dedupe_requests(spark, sf):
    return history.dedupe_requests(view(spark, sf, "requests")).select(
        "request_id", "queue", "idempotency_key", "task_request_id", "created"
    )


def submit_requests(spark, sf):
    """Requests after the cut against the tasks that the earlier ones created."""
    requests = view(spark, sf, "requests")
    earlier = requests.where(F.col("requested_at") < now())
    known = writes.submit(_no_tasks(spark), earlier).where("created")
    found = writes.submit(known, requests.where(F.col("requested_at") >= now()))
    return found.drop("task_name", "params", "requested_at")


def submit_with_hook(spark, sf):
    """Requests whose hook names the queue in the task name and refuses nothing by itself."""
    requests = view(spark, sf, "requests")

    def named(rows):
        return rows.withColumn("task_name", F.concat("queue", F.lit("/"), "task_name"))

    found = writes.submit(_no_tasks(spark), requests, hook=named)
    return found.select("request_id", "queue", "task_id", "created", "task_name", "params", "problem")


def claim_from_history(spark, sf):
    """Submitted tasks, folded from their spawn rows and claimed."""
    submitted = writes.submit(_no_tasks(spark), view(spark, sf, "requests"))
    state = history.fold_state(writes.spawn_history(submitted), now=now())
    claimed = writes.claim(state, now(), 50, 2_500)
    return claimed.select("queue", "task_id", "run_id", "attempt", "op", "ts", "seq", "lease_s")


def _waiting(spark, sf):
    """The history up to the cut, half of its waits for events without a timeout."""
    lasting = (F.col("op") == "await_event") & (F.col("seq") % 4 == 0)
    rows = view(spark, sf, "transitions").where(F.col("ts") <= now())
    return rows.withColumn("wake_at", F.when(~lasting, F.col("wake_at")))


def _wakes(spark, sf):
    folded = history.fold_state(_waiting(spark, sf), details=True)
    return writes.wake(folded, view(spark, sf, "announced"), now())


def wake_from_events(spark, sf):
    return _wakes(spark, sf).select(
        "queue", "task_id", "run_id", "attempt", "op", "ts", "payload", "event_name"
    )


def claim_woken(spark, sf):
    """The loop closed: fold, wake, fold again, claim, and fold the claims into the state."""
    rows = _waiting(spark, sf)
    rows = rows.unionByName(written(_wakes(spark, sf), "wakes"))
    folded = history.fold_state(rows, details=True)
    claims = written(writes.claim(folded, now(), 40, 2_500), "claims")
    after = history.fold_state(
        rows.unionByName(writes.claim_history(claims)), as_of=now(), details=True
    )
    return after.where("state = 'running' AND lease_until > updated_at").select(
        "queue", "task_id", "run_id", "attempt", "lease_until", "wake_event", "event_payload"
    ).where(F.col("lease_until") == now() + F.expr("interval 3 seconds"))


def spawned_options(spark, sf):
    """Options of submitted tasks, through the history and back."""
    small = F.col("request_id").cast("long") % 3 == 0
    requests = view(spark, sf, "requests").select(
        "*",
        F.create_map(F.lit("queue"), F.col("queue")).alias("headers"),
        F.when(small, "exponential").alias("retry_kind"),
        F.lit(30.0).alias("retry_base_seconds"),
        F.lit(None).cast("double").alias("retry_factor"),
        F.lit(600.0).alias("retry_max_seconds"),
        F.when(~small, 3_600).cast("long").alias("max_delay_s"),
        F.lit(60).cast("long").alias("max_duration_s"),
    )
    stored = writes.spawn_history(writes.submit(_no_tasks(spark), requests))
    folded = history.fold_state(stored, details=True)
    overdue = history.cancel_overdue(folded, now())
    return overdue.select(
        "queue", "task_id", "params", F.element_at("headers", "queue").alias("header"),
        F.col("retry_strategy.kind").alias("retry_kind"),
        F.col("retry_strategy.max_seconds").alias("retry_max_seconds"), "max_delay_s",
        "max_duration_s", "state", "ended_at",
    )


def _no_tasks(spark):
    return spark.createDataFrame(
        [], "queue string, idempotency_key string, task_id string, run_id string, attempt int"
    )


def fold_state(spark, sf):
    return snapshot(spark, sf)


def fold_state_as_of(spark, sf):
    return snapshot(spark, sf, as_of=now())


def expired_leases(spark, sf):
    folded = history.fold_state(view(spark, sf, "transitions"), as_of=now(), now=now())
    return folded.select("queue", "task_id", "state", "attempt", "ended_at", "updated_at")


def terminal_tasks(spark, sf):
    rows = snapshot(spark, sf)
    ended = history.is_terminal(F.col("state"))
    return rows.groupBy("queue", "state").agg(
        F.count(F.lit(1)).alias("tasks"), F.count_if(ended).alias("terminal")
    )


def rejected_writes(spark, sf):
    rows = history.rejected_writes(view(spark, sf, "transitions"))
    return rows.select("queue", "task_id", "seq", "op", "generation", "ended_by", "reason", "code")


def occurrence_names(spark, sf):
    calls = view(spark, sf, "steps")
    return steps.occurrence_names(calls, ["task_id"], ["ts", "seq"])


def allocate_names(spark, sf):
    calls = _literal_calls(spark, sf)
    return steps.allocate_names(calls, ["task_id"], ["ts", "seq"])


def _literal_calls(spark, sf):
    """Steps of which about a quarter are literals such as ``view#3``."""
    name = F.when(F.col("seq") % 4 == 0, F.concat("name", F.lit("#"), F.col("seq") % 5)).otherwise(
        F.col("name")
    )
    nested = F.when(F.col("seq") % 16 == 0, F.concat(name, F.lit("#2"))).otherwise(name)
    return view(spark, sf, "steps").withColumn("name", nested)


def due_batch(spark, sf):
    return history.due_batch(view(spark, sf, "runs"), now(), 25)


def attempt_sequence(spark, sf):
    return history.attempt_sequence(view(spark, sf, "transitions"))


def attempt_budget(spark, sf):
    return history.attempt_budget(view(spark, sf, "transitions"))


def named_steps(spark, sf):
    return view(spark, sf, "steps").select(
        "task_id",
        F.concat("name", F.lit("-"), (F.col("seq") % 20).cast("string")).alias("checkpoint_name"),
        "seq",
    )


def replay_steps(spark, sf):
    return history.replay(named_steps(spark, sf), view(spark, sf, "checkpoints"))


def remaining_steps(spark, sf):
    return history.remaining(named_steps(spark, sf), view(spark, sf, "checkpoints"))


def visible_checkpoints(spark, sf):
    both = history.latest_checkpoints(view(spark, sf, "checkpoints"), include_pending=True)
    committed = history.latest_checkpoints(view(spark, sf, "checkpoints"))
    return both.withColumn("view", F.lit("all")).unionByName(
        committed.withColumn("view", F.lit("committed"))
    )


def apply_cancels(spark, sf):
    cancels = view(spark, sf, "task_requests").where("milliseconds > 60000")
    cancels = cancels.select("queue", "task_id", F.col("ts").alias("cancelled_at"))
    rows = history.apply_cancels(snapshot(spark, sf), cancels)
    return rows.select("queue", "task_id", "state", "ended_at")


STEP_VIEW = """, named AS (
    SELECT task_id, concat(name, '-', CAST(seq % 20 AS VARCHAR)) AS checkpoint_name, seq
    FROM steps),
  committed AS (
    SELECT * FROM checkpoints WHERE status = 'committed'
    QUALIFY row_number() OVER (PARTITION BY task_id, checkpoint_name
                               ORDER BY updated_at DESC, owner_run_id DESC) = 1)"""

SUBMITTED = """, submitted AS (
    SELECT *, md5(concat(queue, chr(1), winner)) AS task_id, request_id = winner AS created
    FROM (SELECT *, CASE WHEN idempotency_key IS NULL THEN request_id
            ELSE first_value(request_id) OVER (PARTITION BY queue, idempotency_key
                 ORDER BY requested_at, request_id) END AS winner
          FROM requests))"""

QUERIES = {
    "submit_with_hook": (
        submit_with_hook,
        sql(
            "requests",
            body=SUBMITTED
            + """ SELECT request_id, queue, task_id, created,
                    concat(queue, '/', task_name) AS task_name, params,
                    CAST(NULL AS VARCHAR) AS problem FROM submitted""",
        ),
    ),
    "claim_from_history": (
        claim_from_history,
        sql(
            "requests",
            body=SUBMITTED
            + """ SELECT queue, task_id, md5(concat(task_id, chr(1), '1')) AS run_id,
                    CAST(1 AS INTEGER) AS attempt, 'claim' AS op, $now AS ts,
                    row_number() OVER (PARTITION BY queue
                      ORDER BY md5(concat(task_id, chr(1), '1'))) AS seq,
                    CAST(3 AS BIGINT) AS lease_s
                  FROM submitted WHERE created QUALIFY seq <= 50""",
            now=f"TIMESTAMP '{NOW}'",
        ),
    ),
    "first_events": (
        first_events,
        sql(
            "signals",
            body="""SELECT queue, event_name, arg_min(payload, (emitted_at, seq)) AS payload,
                    min(emitted_at) AS emitted_at, count(*) AS emitted
                    FROM signals GROUP BY ALL""",
        ),
    ),
    "dedupe_requests": (
        dedupe_requests,
        sql(
            "requests",
            body="""SELECT request_id, queue, idempotency_key, task_request_id,
                    request_id = task_request_id AS created FROM (
                      SELECT *, CASE WHEN idempotency_key IS NULL THEN request_id
                        ELSE first_value(request_id) OVER (PARTITION BY queue, idempotency_key
                             ORDER BY requested_at, request_id) END AS task_request_id
                      FROM requests)""",
        ),
    ),
    "submit_requests": (
        submit_requests,
        sql(
            "requests",
            body="""SELECT request_id, queue, idempotency_key, task_id,
                    md5(concat(task_id, chr(1), '1')) AS run_id, CAST(1 AS INTEGER) AS attempt,
                    request_id = winner AS created, CAST(NULL AS VARCHAR) AS problem FROM (
                      SELECT *, md5(concat(queue, chr(1), winner)) AS task_id FROM (
                        SELECT *, CASE WHEN idempotency_key IS NULL THEN request_id
                          ELSE first_value(request_id) OVER (PARTITION BY queue, idempotency_key
                               ORDER BY requested_at, request_id) END AS winner
                        FROM requests))
                    WHERE requested_at >= $now""",
            now=f"TIMESTAMP '{NOW}'",
        ),
    ),
    "fold_state": (fold_state, fold_sql(" SELECT * FROM snapshot")),
    "fold_state_as_of": (
        fold_state_as_of,
        fold_sql(" SELECT * FROM snapshot", where=f"WHERE ts <= TIMESTAMP '{NOW}'"),
    ),
    "expired_leases": (
        expired_leases,
        fold_sql(
            """ SELECT queue, task_id,
                CASE WHEN NOT gone THEN state WHEN attempt >= max_attempts THEN 'failed'
                     ELSE 'pending' END AS state,
                CASE WHEN gone AND attempt < max_attempts THEN attempt + 1 ELSE attempt END
                    AS attempt,
                CASE WHEN gone AND attempt >= max_attempts THEN lease_until ELSE ended_at END
                    AS ended_at,
                CASE WHEN gone THEN lease_until ELSE updated_at END AS updated_at
                FROM (SELECT *, state = 'running' AND coalesce(lease_until <= $now, false) AS gone
                      FROM snapshot)""",
            where=f"WHERE ts <= TIMESTAMP '{NOW}'",
        ),
    ),
    "terminal_tasks": (
        terminal_tasks,
        fold_sql(
            """ SELECT queue, state, count(*) AS tasks,
                count(*) FILTER (state IN ('completed', 'failed', 'cancelled')) AS terminal
                FROM snapshot GROUP BY ALL"""
        ),
    ),
    "wake_from_events": (
        wake_from_events,
        woken_sql("""SELECT queue, task_id, run_id, attempt, 'wake' AS op, ts, payload, event_name
                     FROM woken"""),
    ),
    "claim_woken": (
        claim_woken,
        woken_sql("""SELECT queue, task_id, run_id, attempt, $now + INTERVAL 3 SECOND AS lease_until,
                       CASE WHEN NOT arrived AND state = 'sleeping' THEN event_name END AS wake_event,
                       CASE WHEN arrived THEN payload END AS event_payload
                     FROM (SELECT s.*, w.payload, w.task_id IS NOT NULL AS arrived
                           FROM snapshot s LEFT JOIN woken w USING (queue, task_id))
                     WHERE arrived OR state = 'pending' OR (state = 'sleeping' AND wake_at <= $now)
                     QUALIFY row_number() OVER (PARTITION BY queue ORDER BY
                       CASE WHEN arrived THEN NULL ELSE wake_at END NULLS FIRST, run_id) <= 40"""),
    ),
    "spawned_options": (
        spawned_options,
        sql(
            "requests",
            body="""SELECT queue, md5(concat(queue, chr(1), request_id)) AS task_id, params,
                      queue AS header, CASE WHEN small THEN 'exponential' END AS retry_kind,
                      CASE WHEN small THEN CAST(600 AS DOUBLE) END AS retry_max_seconds,
                      CASE WHEN NOT small THEN CAST(3600 AS BIGINT) END AS max_delay_s,
                      CAST(60 AS BIGINT) AS max_duration_s,
                      CASE WHEN over THEN 'cancelled' ELSE 'pending' END AS state,
                      CASE WHEN over THEN requested_at + INTERVAL 1 HOUR END AS ended_at
                    FROM (SELECT *, coalesce(NOT small AND requested_at + INTERVAL 1 HOUR <= $now,
                                             false) AS over
                          FROM (SELECT *, CAST(request_id AS BIGINT) % 3 = 0 AS small FROM requests))
                    QUALIFY idempotency_key IS NULL OR row_number() OVER (
                      PARTITION BY queue, idempotency_key ORDER BY requested_at, request_id) = 1""",
            now=f"TIMESTAMP '{NOW}'",
        ),
    ),
    "rejected_writes": (
        rejected_writes,
        sql(
            "transitions",
            body=GENERATIONS
            + f""", ended AS (
                SELECT *, arg_min(op, (ts, seq)) FILTER (legal AND {ENDS}) OVER g AS ended_by,
                       sum(CASE WHEN legal AND {ENDS} THEN 1 ELSE 0 END) OVER (g ORDER BY ts, seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                FROM generations WHERE generation >= 1
                WINDOW g AS (PARTITION BY queue, task_id, generation))
              SELECT queue, task_id, seq, op, generation,
                     CASE WHEN before >= 1 THEN ended_by END AS ended_by,
                     CASE WHEN before >= 1 THEN ended_by ELSE 'not_running' END AS reason,
                     CASE WHEN before >= 1 THEN CASE ended_by WHEN 'cancel' THEN 'AB001'
                          WHEN 'fail' THEN 'AB002' END END AS code
              FROM ended WHERE before >= 1 OR NOT legal""",
            where="",
        ),
    ),
    "occurrence_names": (
        occurrence_names,
        sql(
            "steps",
            body="""SELECT *, CASE WHEN occurrence = 1 THEN name
                      ELSE concat(name, '#', CAST(occurrence AS VARCHAR)) END AS checkpoint_name
                    FROM (SELECT *, row_number() OVER (PARTITION BY task_id, name
                                                       ORDER BY ts, seq) AS occurrence
                          FROM steps)""",
        ),
    ),
    "allocate_names": (
        allocate_names,
        # Simulates every execution call by call, carrying the allocated names.
        "WITH RECURSIVE "
        + sql(
            "steps",
            body=""", literal AS (
                SELECT task_id, ts, seq,
                       CASE WHEN seq % 16 = 0 THEN concat(step, '#2') ELSE step END AS name
                FROM (SELECT *, CASE WHEN seq % 4 = 0
                                     THEN concat(name, '#', CAST(seq % 5 AS VARCHAR))
                                     ELSE name END AS step FROM steps)),
              calls AS (
                SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ts, seq) AS i
                FROM literal),
              run AS (
                SELECT task_id, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken,
                       CAST([] AS VARCHAR[]) AS counted, CAST(NULL AS TIMESTAMP) AS ts,
                       CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS name,
                       CAST(NULL AS VARCHAR) AS checkpoint_name, CAST(NULL AS BOOLEAN) AS accepted
                FROM (SELECT DISTINCT task_id FROM calls)
                UNION ALL
                SELECT task_id, i,
                       CASE WHEN ok THEN list_append(taken, made) ELSE taken END,
                       CASE WHEN ok THEN list_append(counted, name) ELSE counted END,
                       ts, seq, name, made, ok
                FROM (SELECT *, NOT list_contains(taken, made) AS ok FROM (
                        SELECT c.task_id, c.i, c.ts, c.seq, c.name, r.taken, r.counted,
                               CASE WHEN list_contains(r.counted, c.name)
                                    THEN concat(c.name, '#', CAST(1 + len(list_filter(r.counted,
                                                lambda x: x = c.name)) AS VARCHAR))
                                    ELSE c.name END AS made
                        FROM run r JOIN calls c ON c.task_id = r.task_id AND c.i = r.i + 1)))
              SELECT task_id, name, ts, seq, checkpoint_name, accepted FROM run WHERE i > 0""",
        ).removeprefix("WITH "),
    ),
    "due_batch": (
        due_batch,
        sql(
            "runs",
            body="""SELECT *, row_number() OVER (PARTITION BY queue ORDER BY wake_at NULLS FIRST, run_id)
                      AS place FROM runs
                    WHERE wake_at <= $now OR (wake_at IS NULL AND state = 'pending')
                    QUALIFY place <= 25""",
            now=f"TIMESTAMP '{NOW}'",
        ),
    ),
    "attempt_sequence": (
        attempt_sequence,
        sql(
            "transitions",
            body="""SELECT queue, task_id, ts, seq, op AS outcome, row_number() OVER w AS number,
                      lag(op) OVER w AS previous_outcome,
                      (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS gap_s
                    FROM transitions WHERE op IN ('complete', 'fail', 'cancel')
                    WINDOW w AS (PARTITION BY queue, task_id ORDER BY ts, seq)""",
        ),
    ),
    "attempt_budget": (
        attempt_budget,
        sql(
            "transitions",
            body="""SELECT *, greatest(max_attempts - used, 0) AS left,
                      used >= max_attempts AS exhausted
                    FROM (SELECT queue, task_id, max(attempt) AS used,
                                 coalesce(last(max_attempts ORDER BY ts, seq), 5) AS max_attempts
                          FROM transitions GROUP BY ALL)""",
        ),
    ),
    "replay_steps": (
        replay_steps,
        sql(
            "steps",
            "checkpoints",
            body=STEP_VIEW
            + """ SELECT n.*, c.state AS value, c.task_id IS NOT NULL AS done
                  FROM named n LEFT JOIN committed c USING (task_id, checkpoint_name)""",
        ),
    ),
    "remaining_steps": (
        remaining_steps,
        sql(
            "steps",
            "checkpoints",
            body=STEP_VIEW
            + " SELECT * FROM named n ANTI JOIN committed c USING (task_id, checkpoint_name)",
        ),
    ),
    "visible_checkpoints": (
        visible_checkpoints,
        sql(
            "checkpoints",
            body="""SELECT *, 'all' AS view FROM checkpoints
                    QUALIFY row_number() OVER (PARTITION BY task_id, checkpoint_name
                                               ORDER BY updated_at DESC, owner_run_id DESC) = 1
                    UNION ALL
                    SELECT *, 'committed' FROM checkpoints WHERE status = 'committed'
                    QUALIFY row_number() OVER (PARTITION BY task_id, checkpoint_name
                                               ORDER BY updated_at DESC, owner_run_id DESC) = 1""",
        ),
    ),
    "apply_cancels": (
        apply_cancels,
        fold_sql(
            """, cancels AS (SELECT queue, task_id, min(ts) AS cancelled_at FROM task_requests
                             WHERE milliseconds > 60000 GROUP BY ALL)
              SELECT queue, task_id, CASE WHEN wins THEN 'cancelled' ELSE state END AS state,
                     CASE WHEN wins THEN cancelled_at ELSE ended_at END AS ended_at
              FROM (SELECT s.*, cancelled_at, cancelled_at IS NOT NULL
                           AND (ended_at IS NULL OR cancelled_at < ended_at) AS wins
                    FROM snapshot s LEFT JOIN cancels USING (queue, task_id))""",
            "task_requests",
        ),
    ),
}
