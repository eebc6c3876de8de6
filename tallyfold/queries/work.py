"""User functions over documents: one pass, bounded retries and a durable step."""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from tallyfold.operators.tasks import (
    Err, Ok, Registry, durable_step, run_due, run_tasks, run_with_retries,
)
from tallyfold.operators.tasks import task as registered
from tallyfold.queries.views import read
from tallyfold.session import new_path, written

QUEUE = "documents"


@registered(name="en", max_attempts=3)
def measure(params, context):
    """Counts words; texts of many words fail until the third attempt, huge ones always."""
    words = len(params["text"].split(" "))
    if words > 1000 or (words > 300 and context.attempt < 3):
        return Err(f"{words} words at attempt {context.attempt}")
    return Ok({"words": words})


@registered(name="de")
def strict(params, context):
    if len(params["text"]) > 500:
        raise ValueError("text too long")
    return Ok(len(params["text"]))


REGISTRY = Registry([measure, strict], QUEUE)


def _runs(spark, sf):
    return read(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("task_id"),
        F.col("lang").alias("task_name"),
        F.lit(1).alias("attempt"),
        F.to_json(F.struct("text")).alias("params"),
    )


def tasks_run_once(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    done = written(run_tasks(_runs(spark, sf), REGISTRY, partitions=cores), "outcomes")
    return done.select(
        "task_id", "state", "result", "failure.name", "failure.message", "attempt"
    )


def tasks_with_retries(spark, sf):
    runs = _runs(spark, sf).drop("attempt")
    cores = spark.sparkContext.defaultParallelism
    done = run_with_retries(runs, REGISTRY, new_path(spark, "attempts"), partitions=cores)
    return done.select("task_id", "attempt", "state", "result", "failure.message")


def durable_steps(spark, sf):
    """Run the step twice over the same store; the second run finds everything done."""
    store = new_path(spark, "checkpoints")
    rows = _runs(spark, sf).select("task_id", "params")
    durable_step(rows, "measure", measure, store)
    return durable_step(rows, "measure", measure, store).select(
        "task_id", "checkpoint_name", "value", "done"
    )


@registered(name="en", batch=True)
def measure_many(rows):
    """Counts the words of many texts at once; a text of over 1,000 words fails its batch."""
    texts = rows.params.str.removeprefix('{"text":"')
    words = texts.str.count(" ") + 1
    if (words > 1000).any():
        raise ValueError("too many words")
    return words.astype(str)


@registered(name="de", batch=True)
def lengths(rows):
    return pd.Series(rows.params.str.len() > 500).map({True: "true", False: "false"})


def batch_tasks(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    registry = Registry([measure_many, lengths], QUEUE)
    done = written(run_tasks(_runs(spark, sf), registry, partitions=cores), "batches")
    return done.select("task_id", "state", "result", "failure.name", "failure.message")


START = datetime(2024, 1, 1)


def due_tasks(spark, sf):
    """The same tasks at four times: retries wait for their delays, late starts are cancelled."""
    waits = Registry(
        [
            registered(name="en", max_attempts=3, retry=("fixed", 60.0, None, None))(measure.run),
            registered(name="de", max_delay_s=50, retry=("exponential", 400.0, 2.0, None))(strict.run),
        ],
        QUEUE,
    )
    age = F.col("task_id").cast("long") % 100
    runs = _runs(spark, sf).drop("attempt").withColumn(
        "spawned_at", F.lit(START).cast("timestamp") - F.make_dt_interval(secs=age.cast("decimal(18,6)"))
    )
    store, cores = new_path(spark, "due"), spark.sparkContext.defaultParallelism
    for seconds in (0, 30, 60, 600):
        done = run_due(runs, waits, store, START + timedelta(seconds=seconds), partitions=cores)
    return done.select(
        "task_id", "attempt", "state", "result", F.col("wake_at").cast("timestamp_ntz").alias("wake_at")
    )


def _doubled(context, execute):
    """A wrapper around every execution: numbers come back doubled."""
    outcome = execute()
    twice = isinstance(outcome, Ok) and isinstance(outcome.value, int)
    return Ok(2 * outcome.value) if twice else outcome


def tasks_wrapped(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    done = written(run_tasks(_runs(spark, sf), REGISTRY, wrap=_doubled, partitions=cores), "wrapped")
    return done.select("task_id", "state", "result")


WORDS = "len(string_split(text, ' '))"
ATTEMPT_SQL = f"""SELECT CAST(doc_id AS VARCHAR) AS task_id, lang, {WORDS} AS words,
    length(text) AS chars FROM documents"""

QUERIES = {
    "run_batch_tasks": (
        batch_tasks,
        f"""SELECT task_id, CASE WHEN lang NOT IN ('en', 'de') THEN 'deferred'
                   WHEN lang = 'en' AND words > 1000 THEN 'failed' ELSE 'completed' END AS state,
              CASE WHEN lang = 'en' AND words <= 1000 THEN CAST(words AS VARCHAR)
                   WHEN lang = 'de' THEN CAST(length(params) > 500 AS VARCHAR) END AS result,
              CASE WHEN lang = 'en' AND words > 1000 THEN 'ValueError' END AS name,
              CASE WHEN lang = 'en' AND words > 1000 THEN 'too many words' END AS message
            FROM (SELECT *, CAST(json_object('text', text) AS VARCHAR) AS params
                  FROM (SELECT CAST(doc_id AS VARCHAR) AS task_id, lang, {WORDS} AS words, text
                        FROM documents))""",
    ),
    "run_due_tasks": (
        due_tasks,
        f"""SELECT task_id, CAST(CASE WHEN lang NOT IN ('en', 'de') THEN 0
                   WHEN lang = 'en' AND words > 300 THEN 3
                   WHEN lang = 'de' AND NOT over AND chars > 500 THEN 2 ELSE 1 END AS INTEGER) AS attempt,
              CASE WHEN lang NOT IN ('en', 'de') THEN 'deferred'
                   WHEN lang = 'de' AND over THEN 'cancelled'
                   WHEN lang = 'en' AND words > 1000 THEN 'failed'
                   WHEN lang = 'de' AND chars > 500 THEN 'sleeping' ELSE 'completed' END AS state,
              CASE WHEN lang = 'en' AND words <= 1000 THEN concat('{{"words": ', words, '}}')
                   WHEN lang = 'de' AND NOT over AND chars <= 500
                   THEN CAST(chars AS VARCHAR) END AS result,
              CASE WHEN lang = 'de' AND NOT over AND chars > 500
                   THEN TIMESTAMP '2024-01-01 00:23:20' END AS wake_at
            FROM (SELECT *, CAST(task_id AS BIGINT) % 100 >= 50 AS over FROM ({ATTEMPT_SQL}))""",
    ),
    "run_tasks": (
        tasks_run_once,
        f"""SELECT task_id, CASE WHEN lang NOT IN ('en', 'de') THEN 'deferred'
                   WHEN bad THEN 'failed' ELSE 'completed' END AS state,
              CASE WHEN NOT bad AND lang = 'en' THEN concat('{{"words": ', words, '}}')
                   WHEN NOT bad AND lang = 'de' THEN CAST(chars AS VARCHAR) END AS result,
              CASE WHEN bad AND lang = 'en' THEN 'TaskError'
                   WHEN bad AND lang = 'de' THEN 'ValueError' END AS name,
              CASE WHEN bad AND lang = 'en' THEN concat(words, ' words at attempt 1')
                   WHEN bad AND lang = 'de' THEN 'text too long' END AS message,
              CAST(1 AS INTEGER) AS attempt
            FROM (SELECT *, CASE lang WHEN 'en' THEN words > 300 WHEN 'de' THEN chars > 500
                                 END AS bad FROM ({ATTEMPT_SQL}))""",
    ),
    "run_wrapped": (
        tasks_wrapped,
        f"""SELECT task_id, CASE WHEN lang NOT IN ('en', 'de') THEN 'deferred'
                   WHEN bad THEN 'failed' ELSE 'completed' END AS state,
              CASE WHEN NOT bad AND lang = 'en' THEN concat('{{"words": ', words, '}}')
                   WHEN NOT bad AND lang = 'de' THEN CAST(2 * chars AS VARCHAR) END AS result
            FROM (SELECT *, CASE lang WHEN 'en' THEN words > 300 WHEN 'de' THEN chars > 500
                                 END AS bad FROM ({ATTEMPT_SQL}))""",
    ),
    "run_with_retries": (
        tasks_with_retries,
        f"""SELECT task_id, CAST(CASE WHEN lang = 'en' AND words > 300 THEN 3
                   WHEN lang = 'de' AND chars > 500 THEN 5 ELSE 1 END AS INTEGER) AS attempt,
              CASE WHEN lang NOT IN ('en', 'de') THEN 'deferred'
                   WHEN (lang = 'en' AND words > 1000) OR (lang = 'de' AND chars > 500)
                   THEN 'failed' ELSE 'completed' END AS state,
              CASE WHEN lang = 'en' AND words <= 1000 THEN concat('{{"words": ', words, '}}')
                   WHEN lang = 'de' AND chars <= 500 THEN CAST(chars AS VARCHAR) END AS result,
              CASE WHEN lang = 'en' AND words > 1000 THEN concat(words, ' words at attempt 3')
                   WHEN lang = 'de' AND chars > 500 THEN 'text too long' END AS message
            FROM ({ATTEMPT_SQL})""",
    ),
    "durable_step": (
        durable_steps,
        f"""SELECT task_id, 'measure' AS checkpoint_name, words <= 300 AS done,
              CASE WHEN words <= 300 THEN concat('{{"words": ', words, '}}') END AS value
            FROM ({ATTEMPT_SQL})""",
    ),
}
