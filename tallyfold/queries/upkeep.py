"""Retention, policies and partitions over orders and shipments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import retention
from tallyfold.queries.views import RETENTION_NOW, sql, view
from tallyfold.session import new_path
from tallyfold.sources.tables import drop_stored_queues, read_history, remove_rows, write_history

AT_NOW = f"TIMESTAMP '{RETENTION_NOW}'"
TTL_DAYS = 400
TTL_S = TTL_DAYS * 86_400
LIMIT = 100
TASK_KEY = ["queue", "task_id"]


def now():
    return F.lit(RETENTION_NOW).cast("timestamp_ntz")


def doomed_tasks(spark, sf):
    return retention.cleanup_tasks(view(spark, sf, "ended_tasks"), now(), TTL_S, LIMIT)


def surviving_tasks(spark, sf):
    tasks = view(spark, sf, "ended_tasks")
    return retention.survivors(tasks, doomed_tasks(spark, sf), TASK_KEY)


def doomed_events(spark, sf):
    return retention.cleanup_events(view(spark, sf, "shipments"), now(), TTL_S, LIMIT)


def _by_policy(spark, sf):
    return retention.cleanup_all(
        view(spark, sf, "ended_tasks"),
        view(spark, sf, "shipments"),
        view(spark, sf, "policies"),
        now(),
    )


def doomed_by_policy(spark, sf):
    return _by_policy(spark, sf)[0]


def cleanup_counts(spark, sf):
    return retention.cleanup_counts(*_by_policy(spark, sf))


def _updates(spark, sf):
    """A partial update for every queue with running tasks, and one new queue."""
    tasks = view(spark, sf, "ended_tasks").where("state = 'running'")
    found = tasks.groupBy("queue").agg(F.count(F.lit(1)).alias("n"))
    return found.select(
        F.when(F.col("queue") == "2-HIGH", F.lit("6-NEW")).otherwise(F.col("queue")).alias("queue"),
        F.when(F.col("queue") < "4", F.concat(F.col("n").cast("string"), F.lit(" seconds"))).alias(
            "cleanup_ttl"
        ),
        F.when(F.col("queue") > "2", F.lit(12)).alias("cleanup_limit"),
        F.lit(None).cast("string").alias("detach_mode"),
        F.lit("4 days").alias("detach_min_age"),
        F.lit(None).cast("string").alias("partition_lookback"),
        F.lit(None).cast("string").alias("partition_lookahead"),
    )


UPDATES = """, updates AS (
    SELECT CASE WHEN queue = '2-HIGH' THEN '6-NEW' ELSE queue END AS queue,
           CASE WHEN queue < '4' THEN concat(CAST(n AS VARCHAR), ' seconds') END AS cleanup_ttl,
           CASE WHEN queue > '2' THEN 12 END AS cleanup_limit,
           CAST(NULL AS VARCHAR) AS detach_mode, '4 days' AS detach_min_age,
           CAST(NULL AS VARCHAR) AS partition_lookback,
           CAST(NULL AS VARCHAR) AS partition_lookahead
    FROM (SELECT queue, count(*) AS n FROM ended_tasks WHERE state = 'running' GROUP BY queue))"""


def upserted_policies(spark, sf):
    return retention.upsert_policies(view(spark, sf, "policies"), _updates(spark, sf))


def queue_policies(spark, sf):
    queues = retention.list_queues(view(spark, sf, "runs")).unionByName(
        retention.list_queues(view(spark, sf, "ended_tasks"))
    )
    return retention.queue_policy(view(spark, sf, "policies"), queues)


def listed_queues(spark, sf):
    return retention.list_queues(view(spark, sf, "ended_tasks"))


def dropped_queues(spark, sf):
    """Drop the queues whose policy detaches empty partitions."""
    gone = view(spark, sf, "policies").where("detach_mode = 'none'")
    return retention.drop_queue(view(spark, sf, "ended_tasks"), gone)


def _partitions(spark, sf):
    rows = view(spark, sf, "ended_tasks").where("ended_at IS NOT NULL")
    return rows.select("queue", F.to_date("ended_at").alias("day"))


EVENT_KEY = ["queue", "event_name", "seq"]


def removed_events(spark, sf):
    """Store the shipments by queue, delete the old ones of two queues there, drop a third queue."""
    path = new_path(spark, "shipments")
    rows = view(spark, sf, "shipments").withColumns(
        {"emitted_at": F.col("emitted_at").cast("timestamp"), "payload": F.lit(None).cast("string")}
    )
    write_history(rows, path, day_of="emitted_at")
    old = doomed_events(spark, sf).where("queue < '3'")
    remove_rows(spark, path, "events", old, EVENT_KEY)
    dropped = rows.select("queue").where("queue > '5'").distinct()
    drop_stored_queues(spark, path, "events", dropped)
    at = F.col("emitted_at").cast("timestamp_ntz")
    return read_history(spark, path, "events").select(*EVENT_KEY, at.alias("emitted_at"))


def partition_plan(spark, sf):
    return retention.partition_plan(view(spark, sf, "policies"), now(), _partitions(spark, sf))


def detach_candidates(spark, sf):
    """Days that have orders of any state but no finished one."""
    tasks = view(spark, sf, "shipments")
    partitions = tasks.select("queue", F.to_date("emitted_at").alias("day")).distinct()
    return retention.detach_candidates(
        partitions, _partitions(spark, sf), view(spark, sf, "policies"), now()
    )


OLD_TASKS = """, doomed AS (
    SELECT *, row_number() OVER (PARTITION BY queue ORDER BY ended_at, task_id) AS place
    FROM ended_tasks
    WHERE state IN ('completed', 'failed', 'cancelled')
      AND ended_at < $now - INTERVAL $ttl DAY
    QUALIFY place <= $limit)"""
BY_POLICY = """, doomed_tasks AS (
    SELECT t.*, row_number() OVER (PARTITION BY queue ORDER BY ended_at, task_id) AS place
    FROM ended_tasks t JOIN policies p USING (queue)
    WHERE state IN ('completed', 'failed', 'cancelled')
      AND ended_at < $now - CAST(cleanup_ttl AS INTERVAL)
    QUALIFY place <= cleanup_limit),
  doomed_events AS (
    SELECT t.*, row_number() OVER (PARTITION BY queue ORDER BY emitted_at, event_name, seq)
               AS place
    FROM shipments t JOIN policies p USING (queue)
    WHERE emitted_at < $now - CAST(cleanup_ttl AS INTERVAL)
    QUALIFY place <= cleanup_limit)"""
RULES = {"now": AT_NOW, "ttl": str(TTL_DAYS), "limit": str(LIMIT)}
POLICY_FIELDS = (
    "cleanup_ttl", "cleanup_limit", "detach_mode", "detach_min_age",
    "partition_lookback", "partition_lookahead",
)

QUERIES = {
    "cleanup_tasks": (
        doomed_tasks,
        sql("ended_tasks", body=OLD_TASKS + " SELECT * FROM doomed", **RULES),
    ),
    "cleanup_survivors": (
        surviving_tasks,
        sql(
            "ended_tasks",
            body=OLD_TASKS
            + " SELECT t.* FROM ended_tasks t ANTI JOIN doomed USING (queue, task_id)",
            **RULES,
        ),
    ),
    "cleanup_events": (
        doomed_events,
        sql(
            "shipments",
            body="""SELECT *, row_number() OVER (PARTITION BY queue
                             ORDER BY emitted_at, event_name, seq) AS place
                    FROM shipments WHERE emitted_at < $now - INTERVAL $ttl DAY
                    QUALIFY place <= $limit""",
            **RULES,
        ),
    ),
    "removed_events": (
        removed_events,
        sql(
            "shipments",
            body=""", doomed AS (
                SELECT *, row_number() OVER (PARTITION BY queue
                          ORDER BY emitted_at, event_name, seq) AS place
                FROM shipments WHERE emitted_at < $now - INTERVAL $ttl DAY
                QUALIFY place <= $limit)
              SELECT queue, event_name, seq, emitted_at FROM shipments s
              ANTI JOIN (SELECT * FROM doomed WHERE queue < '3') d USING (queue, event_name, seq)
              WHERE queue <= '5'""",
            **RULES,
        ),
    ),
    "cleanup_by_policy": (
        doomed_by_policy,
        sql(
            "ended_tasks",
            "shipments",
            "policies",
            body=BY_POLICY + " SELECT * FROM doomed_tasks",
            **RULES,
        ),
    ),
    "cleanup_counts": (
        cleanup_counts,
        sql(
            "ended_tasks",
            "shipments",
            "policies",
            body=BY_POLICY
            + """ SELECT coalesce(t.queue, e.queue) AS queue,
                    coalesce(tasks_deleted, 0) AS tasks_deleted,
                    coalesce(events_deleted, 0) AS events_deleted
                  FROM (SELECT queue, count(*) AS tasks_deleted FROM doomed_tasks GROUP BY 1) t
                  FULL JOIN (SELECT queue, count(*) AS events_deleted FROM doomed_events
                             GROUP BY 1) e ON t.queue = e.queue""",
            **RULES,
        ),
    ),
    "upsert_policies": (
        upserted_policies,
        sql(
            "ended_tasks",
            "policies",
            body=UPDATES
            + " SELECT coalesce(c.queue, u.queue) AS queue, "
            + ", ".join(f"coalesce(u.{f}, c.{f}) AS {f}" for f in POLICY_FIELDS)
            + " FROM policies c FULL JOIN updates u ON c.queue = u.queue",
        ),
    ),
    "queue_policies": (
        queue_policies,
        sql(
            "runs",
            "ended_tasks",
            "policies",
            body="""SELECT * FROM (SELECT DISTINCT queue FROM runs
                                   UNION ALL SELECT DISTINCT queue FROM ended_tasks)
                    LEFT JOIN policies USING (queue)""",
        ),
    ),
    "list_queues": (
        listed_queues,
        sql("ended_tasks", body="SELECT DISTINCT queue FROM ended_tasks ORDER BY queue"),
    ),
    "drop_queue": (
        dropped_queues,
        sql(
            "ended_tasks",
            "policies",
            body="""SELECT * FROM ended_tasks WHERE queue NOT IN
                    (SELECT queue FROM policies WHERE detach_mode = 'none')""",
        ),
    ),
    "partition_plan": (
        partition_plan,
        sql(
            "ended_tasks",
            "policies",
            body="""SELECT w.queue, w.day, h.day IS NULL AS missing FROM (
                      SELECT queue, CAST(unnest(generate_series(
                               CAST(CAST($now - CAST(partition_lookback AS INTERVAL) AS DATE)
                                    AS TIMESTAMP),
                               CAST(CAST($now + CAST(partition_lookahead AS INTERVAL) AS DATE)
                                    AS TIMESTAMP),
                               INTERVAL 1 DAY)) AS DATE) AS day
                      FROM policies WHERE partition_lookahead IS NOT NULL) w
                    LEFT JOIN (SELECT DISTINCT queue, CAST(ended_at AS DATE) AS day
                               FROM ended_tasks WHERE ended_at IS NOT NULL) h
                    ON w.queue = h.queue AND w.day = h.day""",
            now=AT_NOW,
        ),
    ),
    "detach_candidates": (
        detach_candidates,
        sql(
            "ended_tasks",
            "shipments",
            "policies",
            body="""SELECT d.queue, d.day FROM (
                      SELECT DISTINCT queue, CAST(emitted_at AS DATE) AS day FROM shipments) d
                    JOIN policies p ON p.queue = d.queue AND p.detach_mode = 'empty'
                     AND d.day < CAST($now - CAST(detach_min_age AS INTERVAL) AS DATE)
                    ANTI JOIN (SELECT queue, CAST(ended_at AS DATE) AS day FROM ended_tasks
                               WHERE ended_at IS NOT NULL) h
                    ON h.queue = d.queue AND h.day = d.day""",
            now=AT_NOW,
        ),
    ),
}
