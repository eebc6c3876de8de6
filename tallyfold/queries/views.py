"""Workflow-shaped views over the given tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOW = "2024-01-20 00:00:00"
RETENTION_NOW = "2001-01-01 00:00:00"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Each view is one SELECT that Spark and DuckDB both accept.
VIEWS = {
    "requests": """
        SELECT CAST(event_id AS STRING) AS request_id, event_type AS queue,
               event_type AS task_name,
               CASE WHEN value >= 5 THEN CAST(user_id AS STRING) END AS idempotency_key,
               props AS params, ts AS requested_at
        FROM events""",
    "signals": """
        SELECT 'orders' AS queue, CAST(user_id AS STRING) AS event_name, props AS payload,
               ts AS emitted_at, event_id AS seq
        FROM events WHERE event_type = 'purchase'""",
    "announced": """
        SELECT concat('q', CAST(user_id % 3 AS STRING)) AS queue,
               concat('event ', CAST(event_id % 11 AS STRING)) AS event_name, props AS payload,
               ts AS emitted_at, event_id AS seq
        FROM events WHERE event_type = 'purchase'""",
    "waits": """
        SELECT CAST(event_id AS STRING) AS wait_id, 'orders' AS queue,
               CAST(user_id AS STRING) AS event_name, ts AS wait_ts,
               CASE WHEN value >= 1 THEN CAST(86400 AS BIGINT) END AS timeout_s
        FROM events WHERE event_type = 'signup'""",
    "transitions": """
        SELECT concat('q', CAST(user_id % 4 AS STRING)) AS queue,
               md5(CAST(user_id AS STRING)) AS task_id,
               md5(concat(CAST(user_id AS STRING), '-run')) AS run_id,
               CAST(1 + event_id % 3 AS INT) AS attempt,
               CASE WHEN user_id % 5 > 0 THEN CAST(1 + user_id % 5 AS INT) END AS max_attempts,
               concat('user ', CAST(user_id AS STRING)) AS task_name,
               CASE event_type
                    WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'retry' ELSE 'spawn' END
                    WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'heartbeat'
                                     WHEN 1 THEN 'checkpoint' ELSE 'claim' END
                    WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'await_event'
                                      ELSE 'schedule' END
                    WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN 'cancel'
                                         ELSE 'complete' END
                    ELSE 'fail' END AS op,
               ts, event_id AS seq, props AS payload,
               CASE WHEN event_type IN ('click', 'error') THEN ts + INTERVAL 1 HOUR END AS wake_at,
               CASE WHEN event_type = 'view' AND event_id % 4 <> 1
                    THEN CAST(7200 * (1 + event_id % 3) AS BIGINT) END AS lease_s,
               CASE WHEN event_type = 'click' AND event_id % 2 = 0
                    THEN concat('event ', CAST(event_id % 7 AS STRING)) END AS event_name
        FROM events""",
    "steps": """
        SELECT md5(CAST(user_id AS STRING)) AS task_id, event_type AS name, ts, event_id AS seq
        FROM events""",
    "checkpoints": """
        SELECT md5(CAST(user_id AS STRING)) AS task_id,
               concat(event_type, '-', CAST(event_id % 20 AS STRING)) AS checkpoint_name,
               CASE WHEN value >= 2 THEN props END AS state,
               CASE WHEN value < 60 THEN 'committed' ELSE 'pending' END AS status,
               md5(CAST(event_id AS STRING)) AS owner_run_id, ts AS updated_at
        FROM events""",
    "runs": """
        SELECT md5(CAST(event_id AS STRING)) AS run_id, event_type AS queue, ts AS started_at,
               ts + INTERVAL 1 HOUR AS ended_at,
               CASE WHEN event_id % 9 > 0 THEN ts + INTERVAL 1 HOUR END AS wake_at,
               CASE WHEN value < 40 THEN 'sleeping' ELSE 'pending' END AS state
        FROM events""",
    "beats": """
        SELECT md5(CAST(user_id AS STRING)) AS run_id, ts, event_id AS seq,
               CAST(14400 AS BIGINT) AS lease_s, CAST(NULL AS TIMESTAMP) AS run_ended_at
        FROM events""",
    "ended_tasks": """
        SELECT o_orderpriority AS queue, md5(CAST(o_orderkey AS STRING)) AS task_id,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'running'
                    ELSE 'pending' END AS state,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS ended_at
        FROM orders""",
    "shipments": """
        SELECT o_orderpriority AS queue, md5(CAST(l_orderkey AS STRING)) AS event_name,
               l_shipdate AS emitted_at,
               l_orderkey * 1000000000 + l_partkey * 1000 + l_linenumber AS seq
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "policies": """
        SELECT DISTINCT o_orderpriority AS queue,
               concat(CAST(10 * length(o_orderpriority) AS STRING), ' days') AS cleanup_ttl,
               CAST(7 * length(o_orderpriority) AS INT) AS cleanup_limit,
               CASE WHEN length(o_orderpriority) > 5 THEN 'empty' ELSE 'none' END AS detach_mode,
               '45 days' AS detach_min_age, '3 days' AS partition_lookback,
               CASE WHEN o_orderpriority <> '5-LOW' THEN '35 days' END AS partition_lookahead
        FROM orders""",
    "catalog": """
        SELECT CAST(n_nationkey AS STRING) AS task_name, n_name AS callable,
               CASE WHEN n_regionkey > 0 THEN concat('region-', CAST(n_regionkey AS STRING)) END
                   AS catalog_queue,
               CASE WHEN n_regionkey > 1 THEN CAST(n_regionkey AS INT) END AS default_max_attempts,
               CASE WHEN n_regionkey > 2 THEN CAST(60 * n_regionkey AS BIGINT) END
                   AS default_max_duration_s,
               CASE WHEN n_regionkey <> 2 THEN CAST(30 * n_nationkey AS BIGINT) END
                   AS default_max_delay_s
        FROM nation
        UNION ALL
        SELECT CAST(n_nationkey AS STRING), concat(n_name, ' twice'), 'region-1', CAST(9 AS INT),
               CAST(NULL AS BIGINT), CAST(7 AS BIGINT)
        FROM nation WHERE n_regionkey = 2""",
    "named_requests": """
        SELECT CAST(c_custkey AS STRING) AS request_id, CAST(c_nationkey AS STRING) AS task_name,
               md5(CAST(c_custkey AS STRING)) AS run_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'region-1' WHEN 'MACHINERY' THEN 'default'
                    END AS queue,
               CASE WHEN c_acctbal < 2000 THEN CAST(1 + c_custkey % 4 AS INT) END AS max_attempts,
               CASE WHEN c_acctbal > 7000 THEN CAST(c_custkey AS BIGINT) END AS max_duration_s,
               CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS BIGINT) END AS max_delay_s
        FROM customer""",
    "spans": """
        SELECT concat(CAST(conv_id AS STRING), '-',
                      CAST(CASE WHEN role = 'assistant' THEN turn - 1 ELSE turn END AS STRING))
                   AS span_id,
               'runner' AS component, 'turn' AS operation,
               CASE WHEN role = 'assistant' AND length(text) < 80 THEN 'exception'
                    WHEN role = 'assistant' THEN 'stop' ELSE 'start' END AS phase,
               TIMESTAMP '2024-01-01 00:00:00' + turn * INTERVAL 1 MINUTE
                   + (CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)
                   * INTERVAL 1 SECOND AS ts,
               CASE WHEN role = 'assistant' AND length(text) > 200 THEN 'completed' END AS outcome,
               CASE WHEN role = 'assistant' AND length(text) < 80 THEN 'short' END AS error_kind
        FROM conversations WHERE role IN ('user', 'assistant')""",
    "measured_spans": """
        SELECT event_type AS operation,
               CASE WHEN value < 10 THEN 'completed' WHEN value < 40 THEN 'failed'
                    ELSE 'suspended' END AS outcome,
               CASE WHEN value BETWEEN 10 AND 20 THEN 'timeout' END AS error_kind,
               value AS duration_s, ts
        FROM events""",
    "failures": """
        SELECT doc_id, source AS name, text AS message, lang FROM documents""",
    "task_requests": """
        SELECT concat('q', CAST(user_id % 4 AS STRING)) AS queue,
               md5(CAST(user_id AS STRING)) AS task_id, event_type, ts, event_id AS seq,
               props AS payload, CAST(round(value * 100) AS BIGINT) * 10 AS milliseconds
        FROM events""",
}

# The same types under the names of each engine.
_SPARK_WORDS = {"CAST(NULL AS TIMESTAMP)": "CAST(NULL AS TIMESTAMP_NTZ)",
                "TIMESTAMP '2024": "TIMESTAMP_NTZ '2024"}
_VIEW_TABLES = {
    name: [t for t in TABLES if t in body.replace(",", " ").split()] for name, body in VIEWS.items()
}


def view(spark: SparkSession, sf_dir: str, name: str, **tables: DataFrame) -> DataFrame:
    """One of ``VIEWS`` as a DataFrame; ``tables`` replaces given tables, say by streams."""
    body = VIEWS[name]
    for word, spark_word in _SPARK_WORDS.items():
        body = body.replace(word, spark_word)
    for t in _VIEW_TABLES[name]:
        tables.setdefault(t, read(spark, sf_dir, t))
    for t in tables:
        body = _reference(body, t)
    return spark.sql(body, **tables)


def _reference(body: str, table: str) -> str:
    for word in ("FROM", "JOIN"):
        body = body.replace(f"{word} {table}", f"{word} {{{table}}}")
    return body


def sql(*views: str, body: str, **values: str) -> str:
    """``body`` after the named views as common table expressions."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in views]
    text = f"WITH {', '.join(parts)} {body}" if parts else body
    for key, value in values.items():
        text = text.replace(f"${key}", value)
    return text
