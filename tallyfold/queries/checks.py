"""Input audits and scalar rules over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import payload, text, timing
from tallyfold.operators import audits, history, observe
from tallyfold.queries.joins import UUID_OF
from tallyfold.queries.views import read, sql, view

SHORT, LONG = 32, 4096


def _cut_sql(column: str, maximum: int) -> str:
    room = maximum - 3
    lengths = f"range({room // 4}, {room + 1})"
    fits = f"list_filter({lengths}, lambda k: strlen(left({column}, k)) <= {room})"
    return (
        f"CASE WHEN strlen({column}) <= {maximum} THEN {column} "
        f"ELSE concat(left({column}, list_max({fits})), '...') END"
    )


def audited_names(spark, sf):
    documents = read(spark, sf, "documents").select(
        "doc_id",
        F.concat("source", F.lit(" "), "text").alias("queue"),
        F.regexp_replace("lang", "en", "  ").alias("step"),
    )
    return audits.audit_names(documents, "queue", ["step"]).drop("queue")


def audited_json(spark, sf):
    """Event payloads, and the raw text of documents as payloads that are not JSON."""
    events = read(spark, sf, "events").select(
        F.col("event_type").alias("queue"),
        F.when(F.col("value") >= 1, F.col("props")).alias("payload"),
    )
    documents = read(spark, sf, "documents").select(
        F.col("lang").alias("queue"), F.concat(F.lit("{"), "text").alias("payload")
    )
    return audits.audit_json(events.unionByName(documents), "payload", "queue")


def audited_options(spark, sf):
    options = read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        (F.col("l_quantity") - 2).cast("int").alias("max_attempts"),
        F.element_at(
            F.create_map(*[F.lit(v) for v in ("A", "fixed", "N", "none", "R", "linear")]),
            F.col("l_returnflag"),
        ).alias("retry_kind"),
        (F.col("l_extendedprice") * 2).alias("retry_base_seconds"),
        (F.col("l_discount") - 0.02).alias("retry_factor"),
        (F.col("l_extendedprice") - 3000).alias("retry_max_seconds"),
        (F.col("l_suppkey") - 5).alias("max_delay_s"),
    )
    checked = audits.audit_options(options)
    return checked.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.array_join("problems", ",").alias("problems")
    )


def contract_audit(spark, sf):
    rows = view(spark, sf, "transitions").withColumn(
        "task_id", F.when(F.col("op") == "fail", F.lit("short")).otherwise(F.col("task_id"))
    )
    ops = ("spawn", "retry", "claim", "heartbeat", "checkpoint", "complete", "cancel", "fail")
    return audits.contract_violations(
        rows,
        ids=["task_id", "run_id"],
        counts=["seq"],
        positives=["attempt"],
        enums={"op": ops},
    )


def classified_errors(spark, sf):
    errors = read(spark, sf, "events").select(
        "event_id",
        F.when(F.col("value") > 80, "AB001").when(F.col("value") > 60, "AB002").alias("sqlstate"),
        F.when(F.col("value") < 5, "queue_timeout")
        .when(F.col("value") < 20, "closed")
        .alias("connection_reason"),
        F.when(F.col("event_type") == "view", "get_task_result")
        .when(F.col("event_type") == "click", "spawn_task")
        .when(F.col("event_type") == "signup", "emit_event")
        .otherwise("schema_version")
        .alias("operation"),
    )
    return audits.classify_errors(errors)


def safe_rows(spark, sf):
    rows = view(spark, sf, "transitions")
    named = rows.withColumn("task_name", F.repeat("task_name", 20))
    return observe.safe_projection(named)


def idempotency_keys(spark, sf):
    steps = view(spark, sf, "steps")
    return steps.select("seq", text.idempotency_key(F.col("task_id"), F.col("name")).alias("key"))


def canonical_uuids(spark, sf):
    steps = view(spark, sf, "steps")
    return steps.select("seq", text.canonical_uuid(F.col("task_id")).alias("uuid"))


def bounded_texts(spark, sf):
    return read(spark, sf, "documents").select(
        "doc_id",
        text.bounded_text(F.col("text"), SHORT).alias("short_text"),
        text.bounded_text(F.col("text"), LONG).alias("long_text"),
    )


def failure_records(spark, sf):
    rows = view(spark, sf, "failures").select(
        "doc_id",
        text.failure_record(F.col("name"), F.col("message"), F.col("message")).alias("failure"),
    )
    return rows.select("doc_id", "failure.*")


def rounded_seconds(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        timing.whole_seconds(F.col("l_partkey") * F.col("l_linenumber")).alias("seconds"),
    )


def retry_timelines(spark, sf):
    """Every attempt of a retry policy taken from each order, with its delay."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "fixed")
        .when(F.col("o_orderstatus") == "O", "exponential")
        .otherwise("none")
        .alias("kind"),
        (F.col("o_totalprice") / 1000).alias("base"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit(1.5)).alias("factor"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.lit(900.0)).alias("maximum"),
    )
    attempts = orders.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(5))))
    policy = ("kind", "base", "factor", "maximum", "attempt")
    delay = timing.retry_delay(*[F.col(c) for c in policy])
    return attempts.select("o_orderkey", "attempt", delay.alias("delay_s"))


def lease_deadlines(spark, sf):
    beats = view(spark, sf, "beats")
    ts, lease = F.col("ts"), F.col("lease_s")
    return beats.select(
        "seq",
        timing.warning_deadline(ts, lease).alias("warning_at"),
        timing.hard_deadline(ts, lease).alias("hard_at"),
    )


def wake_times(spark, sf):
    """ISO text of each wake time and the milliseconds left at the middle of the month."""
    runs = view(spark, sf, "runs")
    iso = timing.encode_wake_at(F.col("wake_at"))
    left = timing.remaining_milliseconds(
        timing.decode_wake_at(iso), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    )
    return runs.select("run_id", iso.alias("wake_text"), left.alias("remaining_ms"))


def terminal_snapshots(spark, sf):
    """Encode each transition as a terminal snapshot and read it back."""
    rows = view(spark, sf, "transitions")
    state = (
        F.when(F.col("op") == "complete", "completed")
        .when(F.col("op") == "fail", "failed")
        .when(F.col("op") == "schedule", "cancelled")
    )
    failure = F.struct(
        F.col("task_name").alias("name"),
        F.col("payload").alias("message"),
        F.lit(None).cast("string").alias("stacktrace"),
    )
    encoded = payload.encode_snapshot(state, F.regexp_replace("payload", " ", ""), failure)
    decoded = payload.decode_snapshot(encoded)
    return rows.select(
        "seq",
        encoded.alias("snapshot"),
        decoded["state"].alias("state"),
        decoded["result"].alias("result"),
        decoded["failure"]["message"].alias("message"),
    )


def header_maps(spark, sf):
    events = read(spark, sf, "events")
    base = F.when(F.col("value") >= 5, F.create_map(F.lit("trace"), F.col("props")))
    enriched = payload.put_header(base, "source", F.col("event_type"))
    merged = payload.merge_headers(enriched, F.create_map(F.lit("trace"), F.lit("new")))
    return events.select(
        "event_id",
        F.element_at(enriched, "trace").alias("trace"),
        F.element_at(enriched, "source").alias("source"),
        F.element_at(merged, "trace").alias("merged_trace"),
        F.size(enriched).alias("headers"),
    )


def step_names(spark, sf):
    waits = view(spark, sf, "waits")
    given = F.when(F.col("timeout_s").isNull(), F.concat(F.lit("wait "), "wait_id"))
    child = F.md5(F.col("event_name"))
    return waits.select(
        "wait_id",
        text.event_step_name(given, F.col("event_name")).alias("event_step"),
        text.child_step_name(given, child).alias("child_step"),
    )


def audited_intervals(spark, sf):
    """Documents' texts and order ages as interval strings."""
    ages = view(spark, sf, "policies").select("queue", F.col("cleanup_ttl").alias("text"))
    words = read(spark, sf, "documents").select(
        F.col("lang").alias("queue"), "text"
    )
    orders = read(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("queue"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" hours")).alias("text"),
    )
    rows = ages.unionByName(words).unionByName(orders)
    valid = timing.interval_is_valid(F.col("text"))
    return rows.groupBy("queue").agg(
        F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid")
    )


def cancellation_deadlines(spark, sf):
    orders = read(spark, sf, "orders")
    spawned = F.col("o_orderdate")
    started = F.when(
        F.col("o_orderstatus") != "O", spawned + F.expr("interval 2 hours")
    )
    delay = F.when(F.col("o_totalprice") > 100_000, F.col("o_custkey"))
    duration = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") * 2)
    deadline = timing.cancellation_deadline(spawned, started, delay, duration)
    return orders.select("o_orderkey", deadline.alias("deadline"))


def cancelled_by_policy(spark, sf):
    """Orders as tasks with waiting and running limits in days, at the end of 2000."""
    day = 86_400
    tasks = read(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("spawned_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("started_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("ended_at"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "P", "running")
        .otherwise("pending")
        .alias("state"),
        F.when(F.col("o_totalprice") > 100_000, F.col("o_custkey") * day).alias("max_delay_s"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") * 2 * day).alias(
            "max_duration_s"
        ),
    )
    now = F.lit("2000-12-31").cast("timestamp_ntz")
    rows = history.cancel_overdue(tasks, now)
    return rows.select("o_orderkey", "state", "ended_at")


QUERIES = {
    "cancel_overdue": (
        cancelled_by_policy,
        """SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'F' THEN 'completed'
                  WHEN deadline <= TIMESTAMP '2000-12-31 00:00:00' THEN 'cancelled'
                  WHEN o_orderstatus = 'P' THEN 'running' ELSE 'pending' END AS state,
             CASE WHEN o_orderstatus = 'F' THEN o_orderdate
                  WHEN deadline <= TIMESTAMP '2000-12-31 00:00:00' THEN deadline END AS ended_at
           FROM (SELECT *, CASE WHEN o_orderstatus = 'O'
                     THEN CASE WHEN o_totalprice > 100000
                               THEN o_orderdate + to_days(CAST(o_custkey AS INTEGER)) END
                     ELSE CASE WHEN o_orderpriority <> '5-LOW'
                               THEN o_orderdate + to_days(CAST(o_custkey * 2 AS INTEGER)) END
                     END AS deadline
                 FROM orders)""",
    ),
    "audit_names": (
        audited_names,
        """SELECT doc_id, step,
             CASE WHEN strlen(queue) = 0 THEN 'empty' WHEN strlen(queue) > 57 THEN 'too_long' END
                 AS queue_problem,
             CASE WHEN trim(step) = '' THEN 'empty' END AS step_problem
           FROM (SELECT doc_id, concat(source, ' ', text) AS queue,
                        replace(lang, 'en', '  ') AS step FROM documents)""",
    ),
    "audit_json": (
        audited_json,
        """SELECT queue, count(*) AS rows, count(*) FILTER (payload IS NULL) AS null_payloads,
             count(*) FILTER (payload IS NOT NULL AND NOT json_valid(payload)) AS invalid_payloads
           FROM (SELECT event_type AS queue, CASE WHEN value >= 1 THEN props END AS payload
                 FROM events
                 UNION ALL SELECT lang, concat('{', text) FROM documents)
           GROUP BY queue""",
    ),
    "audit_options": (
        audited_options,
        """SELECT l_orderkey, l_partkey, l_linenumber, array_to_string(list_filter([
             CASE WHEN l_quantity - 2 <= 0 THEN 'max_attempts' END,
             CASE WHEN l_returnflag = 'R' THEN 'retry_kind' END,
             CASE WHEN l_extendedprice * 2 NOT BETWEEN 0 AND 86400 THEN 'retry_base_seconds' END,
             CASE WHEN l_discount - CAST(0.02 AS DOUBLE) < 0 THEN 'retry_factor' END,
             CASE WHEN l_extendedprice - 3000 NOT BETWEEN 0 AND 86400
                  THEN 'retry_max_seconds' END,
             CASE WHEN l_suppkey - 5 < 0 THEN 'max_delay_s' END], lambda x: x IS NOT NULL), ',')
               AS problems
           FROM lineitem""",
    ),
    "audit_contract": (
        contract_audit,
        sql(
            "transitions",
            body="""SELECT count(*) AS rows, count(*) FILTER (op = 'fail') AS task_id_not_id,
                      CAST(0 AS BIGINT) AS run_id_not_id,
                      count(*) FILTER (seq < 0) AS seq_negative,
                      count(*) FILTER (attempt <= 0) AS attempt_not_positive,
                      count(*) FILTER (op IN ('schedule', 'await_event')) AS op_unknown,
                      count(*) FILTER (op IN ('fail', 'schedule', 'await_event')) = 0
                          AS accepted
                    FROM transitions""",
        ),
    ),
    "classify_errors": (
        classified_errors,
        """SELECT *, CASE WHEN sqlstate = 'AB001' THEN 'cancelled'
                          WHEN sqlstate = 'AB002' THEN 'failed_run'
                          WHEN connection_reason = 'closed'
                               AND operation IN ('spawn_task', 'emit_event') THEN 'ambiguous'
                          ELSE 'database' END AS error_kind
           FROM (SELECT event_id,
                   CASE WHEN value > 80 THEN 'AB001' WHEN value > 60 THEN 'AB002' END AS sqlstate,
                   CASE WHEN value < 5 THEN 'queue_timeout' WHEN value < 20 THEN 'closed' END
                       AS connection_reason,
                   CASE event_type WHEN 'view' THEN 'get_task_result' WHEN 'click'
                        THEN 'spawn_task' WHEN 'signup' THEN 'emit_event'
                        ELSE 'schema_version' END AS operation
                 FROM events)""",
    ),
    "safe_projection": (
        safe_rows,
        sql(
            "transitions",
            body="""SELECT queue, CASE WHEN strlen(name) <= 128 THEN name
                             ELSE concat(left(name, 125), '...') END AS task_name,
                      task_id, run_id, attempt, op, ts
                    FROM (SELECT *, repeat(task_name, 20) AS name FROM transitions)""",
        ),
    ),
    "idempotency_keys": (
        idempotency_keys,
        sql("steps", body="SELECT seq, concat(task_id, ':', name) AS key FROM steps"),
    ),
    "canonical_uuids": (
        canonical_uuids,
        sql("steps", body=f"SELECT seq, {UUID_OF.format('task_id')} AS uuid FROM steps"),
    ),
    "bounded_text": (
        bounded_texts,
        f"""SELECT doc_id, {_cut_sql("text", SHORT)} AS short_text,
              {_cut_sql("text", LONG)} AS long_text FROM documents""",
    ),
    "failure_records": (
        failure_records,
        f"""SELECT doc_id, {_cut_sql("name", 128)} AS name, {_cut_sql("message", 4096)} AS message,
              {_cut_sql("trace", 8192)} AS stacktrace
            FROM (SELECT doc_id, source AS name, text AS message,
                    array_to_string(list_slice(string_split(text, chr(10)), 1, 20), chr(10))
                        AS trace
                  FROM documents)""",
    ),
    "whole_seconds": (
        rounded_seconds,
        """SELECT l_orderkey, l_linenumber, l_partkey,
             (l_partkey * l_linenumber + 999) // 1000 AS seconds FROM lineitem""",
    ),
    "retry_timelines": (
        retry_timelines,
        """SELECT o_orderkey, attempt, CASE WHEN maximum IS NULL THEN delay
                    ELSE least(delay, maximum) END AS delay_s
           FROM (SELECT *, CASE kind WHEN 'fixed' THEN base
                   WHEN 'exponential' THEN base * pow(coalesce(factor, 2), attempt - 1)
                   ELSE CAST(0 AS DOUBLE) END AS delay
                 FROM (SELECT o_orderkey, CAST(unnest(range(1, 6)) AS INTEGER) AS attempt,
                         CASE o_orderstatus WHEN 'F' THEN 'fixed' WHEN 'O' THEN 'exponential'
                              ELSE 'none' END AS kind,
                         o_totalprice / 1000 AS base,
                         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(1.5 AS DOUBLE) END
                             AS factor,
                         CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(900 AS DOUBLE) END
                             AS maximum
                       FROM orders))""",
    ),
    "lease_deadlines": (
        lease_deadlines,
        sql(
            "beats",
            body="""SELECT seq, ts + to_seconds(lease_s) AS warning_at,
                      ts + to_seconds(lease_s * 2) AS hard_at FROM beats""",
        ),
    ),
    "wake_times": (
        wake_times,
        sql(
            "runs",
            body="""SELECT run_id, strftime(wake_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS wake_text,
                      greatest((epoch_us(wake_at) - epoch_us(TIMESTAMP '2024-01-15 00:00:00'))
                               // 1000, 0) AS remaining_ms
                    FROM runs""",
        ),
    ),
    "terminal_snapshots": (
        terminal_snapshots,
        sql(
            "transitions",
            body="""SELECT seq, CASE op
                        WHEN 'complete' THEN concat('{"state":"completed","result":',
                                                    replace(payload, ' ', ''), '}')
                        WHEN 'fail' THEN concat('{"state":"failed","failure":{"name":"', task_name,
                             '","message":"', replace(payload, '"', '\\"'),
                             '","stacktrace":null}}')
                        WHEN 'schedule' THEN '{"state":"cancelled"}' END AS snapshot,
                      CASE op WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'failed'
                              WHEN 'schedule' THEN 'cancelled' END AS state,
                      CASE WHEN op = 'complete' THEN replace(payload, ' ', '') END AS result,
                      CASE WHEN op = 'fail' THEN payload END AS message
                    FROM transitions""",
        ),
    ),
    "header_maps": (
        header_maps,
        """SELECT event_id, CASE WHEN value >= 5 THEN props END AS trace, event_type AS source,
             'new' AS merged_trace, CASE WHEN value >= 5 THEN 2 ELSE 1 END AS headers
           FROM events""",
    ),
    "step_names": (
        step_names,
        sql(
            "waits",
            body="""SELECT wait_id, coalesce(given, concat('$awaitEvent:', event_name))
                        AS event_step,
                      coalesce(given, concat('$awaitTaskResult:', md5(event_name))) AS child_step
                    FROM (SELECT *, CASE WHEN timeout_s IS NULL
                                         THEN concat('wait ', wait_id) END AS given
                          FROM waits)""",
        ),
    ),
    "audit_intervals": (
        audited_intervals,
        sql(
            "policies",
            body="""SELECT queue, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid
                    FROM (SELECT queue, trim(text) <> '' AND try_cast(text AS INTERVAL) IS NOT NULL
                                 AS ok
                          FROM (SELECT queue, cleanup_ttl AS text FROM policies
                                UNION ALL SELECT lang, text FROM documents
                                UNION ALL SELECT o_orderpriority,
                                            concat(CAST(o_custkey AS VARCHAR), ' hours')
                                          FROM orders))
                    GROUP BY queue""",
        ),
    ),
    "cancellation_deadlines": (
        cancellation_deadlines,
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O'
                THEN CASE WHEN o_totalprice > 100000 THEN o_orderdate + to_seconds(o_custkey) END
                ELSE CASE WHEN o_orderpriority <> '5-LOW'
                          THEN o_orderdate + INTERVAL 2 HOUR + to_seconds(o_custkey * 2) END
                END AS deadline
           FROM orders""",
    ),
}
