"""Waits, child results, catalog lookups, spans, leases and active runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import catalog, history, observe, waits
from tallyfold.queries.history import fold_sql, now, snapshot
from tallyfold.queries.views import NOW, read, sql, view

AT_NOW = f"TIMESTAMP '{NOW}'"
DEFAULT_QUEUE = "default"

RESOLVED = """, first_signal AS (
    SELECT queue, event_name, arg_min(payload, (emitted_at, seq)) AS payload,
           min(emitted_at) AS event_at
    FROM signals WHERE emitted_at <= $now GROUP BY ALL),
  decided AS (
    SELECT w.*, payload, event_at, wait_ts + to_seconds(timeout_s) AS deadline,
           event_at IS NOT NULL AND (timeout_s IS NULL
               OR event_at < wait_ts + to_seconds(timeout_s)) AS met
    FROM waits w LEFT JOIN first_signal USING (queue, event_name) WHERE wait_ts <= $now),
  resolved AS (
    SELECT wait_id, queue, event_name, wait_ts, timeout_s,
           CASE WHEN met THEN 'resolved' WHEN deadline <= $now THEN 'timed_out'
                ELSE 'sleeping' END AS status,
           CASE WHEN met THEN payload END AS payload,
           CASE WHEN met THEN greatest(wait_ts, event_at) WHEN deadline <= $now THEN deadline END
               AS resolved_at
    FROM decided)"""


def resolved_waits(spark, sf):
    return waits.resolve_waits(view(spark, sf, "waits"), view(spark, sf, "signals"), now())


def wait_outcomes(spark, sf):
    """How many waits are resolved, timed out and sleeping, and how long they took."""
    rows = resolved_waits(spark, sf)
    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in ("wait_ts", "resolved_at")]
    waited = (micros[1] - micros[0]).cast("double") / 1e6
    return rows.groupBy("queue", "status").agg(
        F.count(F.lit(1)).alias("waits"),
        F.max(waited).alias("longest_s"),
        F.min(waited).alias("shortest_s"),
    )


def _parents(spark, sf):
    """Purchases wait for the task of the same user, some of them in their own queue."""
    rows = view(spark, sf, "task_requests")
    own = F.col("milliseconds") % 5 == 0
    return rows.where("event_type = 'purchase'").select(
        F.when(own, F.col("queue")).otherwise(F.lit("parents")).alias("queue"),
        "seq",
        F.when(F.col("milliseconds") % 7 == 0, F.lit("nowhere"))
        .otherwise(F.col("queue"))
        .alias("child_queue"),
        F.col("task_id").alias("child_id"),
    )


PARENTS = """, parents AS (
    SELECT CASE WHEN milliseconds % 5 = 0 THEN queue ELSE 'parents' END AS queue, seq,
           CASE WHEN milliseconds % 7 = 0 THEN 'nowhere' ELSE queue END AS child_queue,
           task_id AS child_id
    FROM task_requests WHERE event_type = 'purchase')"""


def child_results(spark, sf):
    return waits.child_results(_parents(spark, sf), snapshot(spark, sf))


def _ids(spark, sf):
    rows = view(spark, sf, "task_requests")
    return rows.select(
        F.when(F.col("milliseconds") % 7 == 0, F.lit("nowhere"))
        .otherwise(F.col("queue"))
        .alias("queue"),
        "task_id",
        F.when(F.col("milliseconds") % 3 == 0, F.lit("q1")).alias("queue_override"),
        "seq",
    )


IDS = """, ids AS (
    SELECT CASE WHEN milliseconds % 7 = 0 THEN 'nowhere' ELSE queue END AS queue, task_id,
           CASE WHEN milliseconds % 3 = 0 THEN 'q1' END AS queue_override, seq
    FROM task_requests)"""


def fetched_results(spark, sf):
    ids = _ids(spark, sf).drop("queue_override")
    return waits.fetch_results(snapshot(spark, sf), ids)


def referenced_results(spark, sf):
    return waits.results_by_reference(_ids(spark, sf), snapshot(spark, sf))


def _catalog(spark, sf):
    names = view(spark, sf, "catalog")
    return names.withColumn("queue", F.coalesce("catalog_queue", F.lit(DEFAULT_QUEUE)))


def looked_up_tasks(spark, sf):
    runs = view(spark, sf, "named_requests").withColumn(
        "queue", F.coalesce("queue", F.lit(DEFAULT_QUEUE))
    )
    names = _catalog(spark, sf).select("queue", "task_name", "callable")
    found = catalog.lookup(runs, names)
    return found.select("request_id", "queue", "task_name", "callable", "registered")


def deferred_unknown(spark, sf):
    runs = view(spark, sf, "named_requests").withColumn(
        "queue", F.coalesce("queue", F.lit(DEFAULT_QUEUE))
    )
    rows = catalog.defer_unknown(runs, _catalog(spark, sf), now())
    return rows.select("request_id", "queue", "task_name", "run_id", "delay_s", "wake_at")


def resolved_options(spark, sf):
    requests, names = view(spark, sf, "named_requests"), view(spark, sf, "catalog")
    return catalog.resolve_options(requests, names)


def routed_requests(spark, sf):
    requests, names = view(spark, sf, "named_requests"), view(spark, sf, "catalog")
    rows = catalog.route(requests, names, DEFAULT_QUEUE)
    return rows.select("request_id", "task_name", "queue", "routed_queue", "reason")


def _registrations(spark, sf):
    """Parts as callables that register under their own name per brand."""
    return read(spark, sf, "part").select(
        F.col("p_brand").alias("queue"),
        F.col("p_name").alias("task_name"),
        F.col("p_type").alias("callable"),
    )


def duplicate_names(spark, sf):
    return catalog.duplicate_names(_registrations(spark, sf))


def catalog_size(spark, sf):
    return catalog.catalog_size(_registrations(spark, sf))


def paired_spans(spark, sf):
    return observe.pair_spans(view(spark, sf, "spans"))


def span_statistics(spark, sf):
    return observe.span_statistics(view(spark, sf, "measured_spans"))


def _completed(spark, sf):
    return view(spark, sf, "ended_tasks").where("state = 'completed'")


def throughput(spark, sf):
    return observe.throughput(_completed(spark, sf))


def hourly_throughput(spark, sf):
    runs = view(spark, sf, "runs").select("queue", "ended_at")
    return observe.hourly_throughput(runs)


def lease_status(spark, sf):
    rows = observe.lease_status(view(spark, sf, "beats"), now())
    return rows.drop("run_ended_at")


def active_runs(spark, sf):
    return observe.active_runs(view(spark, sf, "runs"), capacity=4)


def active_runs_overall(spark, sf):
    return observe.active_runs(view(spark, sf, "runs"), capacity=16, keys=[])


def claimable_runs(spark, sf):
    """Due and waiting runs per queue."""
    runs = view(spark, sf, "runs")
    return runs.groupBy("queue").agg(
        F.count_if(history.due(F.col("state"), F.col("wake_at"), now())).alias("due"),
        F.count_if(~history.due(F.col("state"), F.col("wake_at"), now())).alias("not_due"),
    )


# A name's only queue, or of several the one that the request or else the client names.
ONE_NAME = f""", names AS (
    SELECT *, coalesce(catalog_queue, '{DEFAULT_QUEUE}') AS queue,
           count(*) OVER (PARTITION BY task_name) AS queues FROM catalog),
  one AS (
    SELECT r.request_id, c.queue, c.default_max_attempts, c.default_max_delay_s,
           c.default_max_duration_s
    FROM named_requests r JOIN names c
      ON c.task_name = r.task_name
     AND (c.queues = 1 OR c.queue = coalesce(r.queue, '{DEFAULT_QUEUE}')))"""
CATALOG = f""", names AS (
    SELECT *, coalesce(catalog_queue, '{DEFAULT_QUEUE}') AS queue FROM catalog),
  named AS (
    SELECT * REPLACE (coalesce(queue, '{DEFAULT_QUEUE}') AS queue) FROM named_requests)"""
UUID_OF = (
    "concat_ws('-', substr({0}, 1, 8), substr({0}, 9, 4), substr({0}, 13, 4), "
    "substr({0}, 17, 4), substr({0}, 21, 12))"
)
FNV_OF = (
    "list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(range(1, 37), "
    "lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT))), "
    "lambda h, b: (xor(h, b) * 16777619) & 4294967295)"
)
ACTIVE = """, changes AS (
    SELECT queue, changed_at, CAST(sum(change) AS BIGINT) AS change FROM (
      SELECT queue, started_at AS changed_at, 1 AS change FROM runs
      UNION ALL SELECT queue, ended_at, -1 FROM runs WHERE ended_at IS NOT NULL)
    GROUP BY ALL)"""

QUERIES = {
    "resolve_waits": (
        resolved_waits,
        sql("signals", "waits", body=RESOLVED + " SELECT * FROM resolved", now=AT_NOW),
    ),
    "wait_outcomes": (
        wait_outcomes,
        sql(
            "signals",
            "waits",
            body=RESOLVED
            + """ SELECT queue, status, count(*) AS waits,
                  max(epoch_us(resolved_at) - epoch_us(wait_ts)) / 1e6 AS longest_s,
                  min(epoch_us(resolved_at) - epoch_us(wait_ts)) / 1e6 AS shortest_s
                  FROM resolved GROUP BY ALL""",
            now=AT_NOW,
        ),
    ),
    "child_results": (
        child_results,
        fold_sql(
            PARENTS
            + """ SELECT p.*, CASE WHEN p.queue = child_queue THEN 'same_queue'
                         WHEN s.state IS NULL THEN 'unknown'
                         WHEN s.state IN ('completed', 'failed', 'cancelled') THEN s.state
                         ELSE 'waiting' END AS status,
                    CASE WHEN p.queue <> child_queue AND s.state = 'completed' THEN result END
                        AS result,
                    CASE WHEN p.queue <> child_queue AND s.state = 'failed' THEN failure END
                        AS failure
                  FROM parents p LEFT JOIN snapshot s
                  ON s.queue = child_queue AND s.task_id = child_id""",
            "task_requests",
        ),
    ),
    "fetch_results": (
        fetched_results,
        fold_sql(
            IDS
            + """ SELECT i.queue, i.task_id, i.seq, state, result, failure
                  FROM ids i LEFT JOIN snapshot s USING (queue, task_id)""",
            "task_requests",
        ),
    ),
    "results_by_reference": (
        referenced_results,
        fold_sql(
            IDS
            + """ SELECT i.*, CASE WHEN queue_override <> i.queue THEN 'queue_mismatch'
                              ELSE coalesce(state, 'unknown') END AS status,
                    CASE WHEN queue_override IS NULL OR queue_override = i.queue THEN result END
                        AS result,
                    CASE WHEN queue_override IS NULL OR queue_override = i.queue THEN failure END
                        AS failure
                  FROM ids i LEFT JOIN snapshot s USING (queue, task_id)""",
            "task_requests",
        ),
    ),
    "lookup_tasks": (
        looked_up_tasks,
        sql(
            "catalog",
            "named_requests",
            body=CATALOG
            + """ SELECT request_id, n.queue, n.task_name, callable,
                    c.task_name IS NOT NULL AS registered
                  FROM named n LEFT JOIN names c USING (queue, task_name)""",
        ),
    ),
    "defer_unknown": (
        deferred_unknown,
        sql(
            "catalog",
            "named_requests",
            body=CATALOG
            + f""" SELECT request_id, queue, task_name, run_id, delay_s,
                    $now + to_seconds(delay_s) AS wake_at
                  FROM (SELECT *, 15 + {FNV_OF.format("uuid")} % 16 AS delay_s FROM (
                          SELECT *, {UUID_OF.format("run_id")} AS uuid FROM named n
                          ANTI JOIN names c USING (queue, task_name)))""",
            now=AT_NOW,
        ),
    ),
    "resolve_options": (
        resolved_options,
        sql(
            "catalog",
            "named_requests",
            body=ONE_NAME
            + """ SELECT r.*, coalesce(max_attempts, default_max_attempts, 5)
                        AS resolved_max_attempts,
                      coalesce(max_delay_s, default_max_delay_s) AS resolved_max_delay_s,
                      coalesce(max_duration_s, default_max_duration_s) AS resolved_max_duration_s
                    FROM named_requests r LEFT JOIN one USING (request_id)""",
        ),
    ),
    "route_requests": (
        routed_requests,
        sql(
            "catalog",
            "named_requests",
            body=ONE_NAME
            + """, routed AS (
                SELECT request_id, r.task_name, r.queue, o.queue AS registered,
                       CASE WHEN r.task_name NOT IN (SELECT task_name FROM names)
                            THEN CASE WHEN r.queue IS NULL THEN 'queue_required' END
                            WHEN r.queue IS DISTINCT FROM o.queue AND r.queue IS NOT NULL
                            THEN 'queue_mismatch'
                            WHEN o.queue IS NULL THEN 'queue_required' END AS reason
                FROM named_requests r LEFT JOIN one o USING (request_id))
              SELECT request_id, task_name, queue, reason,
                     CASE WHEN reason IS NULL THEN coalesce(registered, queue) END AS routed_queue
              FROM routed""",
        ),
    ),
    "duplicate_names": (
        duplicate_names,
        """SELECT p_brand AS queue, p_name AS task_name, count(*) AS registrations,
             min(p_type) AS first_callable, max(p_type) AS last_callable
           FROM part GROUP BY ALL HAVING count(*) > 1""",
    ),
    "catalog_size": (
        catalog_size,
        "SELECT p_brand AS queue, count(DISTINCT p_name) AS names FROM part GROUP BY ALL",
    ),
    "pair_spans": (
        paired_spans,
        sql(
            "spans",
            body="""SELECT a.span_id, a.component, a.operation, a.ts AS started_at,
                      b.ts AS ended_at, (epoch_us(b.ts) - epoch_us(a.ts)) / 1e6 AS duration_s,
                      CASE WHEN b.span_id IS NULL THEN 'open'
                           WHEN b.phase = 'exception' THEN 'exception'
                           ELSE coalesce(b.outcome, 'success') END AS outcome,
                      b.error_kind
                    FROM (SELECT * FROM spans WHERE phase = 'start') a
                    LEFT JOIN (SELECT * FROM spans WHERE phase <> 'start') b USING (span_id)""",
        ),
    ),
    "span_statistics": (
        span_statistics,
        sql(
            "measured_spans",
            body="""SELECT operation, outcome, error_kind, count(*) AS spans,
                      round(sum(duration_s), 6) AS total_s, max(duration_s) AS max_s,
                      quantile_disc(duration_s, 0.5) AS p50_s,
                      quantile_disc(duration_s, 0.95) AS p95_s,
                      quantile_disc(duration_s, 0.99) AS p99_s
                    FROM measured_spans GROUP BY ALL""",
        ),
    ),
    "throughput": (
        throughput,
        sql(
            "ended_tasks",
            body="""SELECT *, completed / elapsed_s AS per_second FROM (
                      SELECT queue, count(*) AS completed, min(ended_at) AS first_at,
                        max(ended_at) AS last_at,
                        (epoch_us(max(ended_at)) - epoch_us(min(ended_at))) / 1e6 AS elapsed_s
                      FROM ended_tasks WHERE state = 'completed' GROUP BY queue)""",
        ),
    ),
    "hourly_throughput": (
        hourly_throughput,
        sql(
            "runs",
            body="""SELECT queue, CAST(date_trunc('hour', ended_at) AS TIMESTAMP) AS hour,
                      count(*) AS completed FROM runs GROUP BY ALL""",
        ),
    ),
    "lease_status": (
        lease_status,
        sql(
            "beats",
            body="""SELECT run_id, ts, seq, lease_s, until, age_s,
                      CASE WHEN age_s >= 2 * lease_s THEN 'expired' WHEN age_s >= lease_s
                           THEN 'warning' ELSE 'ok' END AS status,
                      ts + to_seconds(lease_s) AS warning_at,
                      ts + to_seconds(2 * lease_s) AS expires_at
                    FROM (SELECT *, (epoch_us(until) - epoch_us(ts)) / 1e6 AS age_s FROM (
                            SELECT *, coalesce(lead(ts) OVER (PARTITION BY run_id ORDER BY ts, seq),
                                               $now) AS until
                            FROM beats WHERE ts <= $now))""",
            now=AT_NOW,
        ),
    ),
    "active_runs": (
        active_runs,
        sql(
            "runs",
            body=ACTIVE
            + """ SELECT *, greatest(4 - active, 0) AS free FROM (
                    SELECT *, CAST(sum(change) OVER (PARTITION BY queue ORDER BY changed_at)
                                   AS BIGINT) AS active FROM changes)""",
        ),
    ),
    "active_runs_overall": (
        active_runs_overall,
        sql(
            "runs",
            body=ACTIVE
            + """ SELECT *, greatest(16 - active, 0) AS free FROM (
                    SELECT changed_at, change,
                      CAST(sum(change) OVER (ORDER BY changed_at) AS BIGINT) AS active
                    FROM (SELECT changed_at, CAST(sum(change) AS BIGINT) AS change FROM changes
                          GROUP BY changed_at))""",
        ),
    ),
    "claimable_runs": (
        claimable_runs,
        sql(
            "runs",
            body="""SELECT queue, count(*) FILTER (ready) AS due, count(*) FILTER (NOT ready) AS not_due
                    FROM (SELECT *, coalesce(wake_at <= $now, state = 'pending') AS ready FROM runs)
                    GROUP BY queue""",
            now=AT_NOW,
        ),
    ),
}
