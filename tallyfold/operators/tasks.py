"""User functions over tables: bounded failures, bounded retries and memoised steps.

Every run of user code is written to a store before anything reads it, so lazy evaluation
never calls a function twice. The store is committed task by task (output committer 2): a
job that dies keeps what its finished tasks wrote, and the next run anti-joins it away. User
functions run at least once per Spark task attempt; duplicates are removed when reading.
"""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import schemas as S
from tallyfold.functions.text import failure_record
from tallyfold.functions.timing import after, cancellation_deadline
from tallyfold.operators.audits import RETRY_KINDS
from tallyfold.operators.fold import strategy_delay
from tallyfold.operators.history import replay
from tallyfold.session import read_or_empty

CATALOG = S.struct(
    "queue string, task_name string, callable string, default_max_attempts int, "
    "default_max_delay_s long, default_max_duration_s long"
)
OUTCOMES = S.struct(
    "task_id string, attempt int, state string, result string, "
    "error_name string, error_message string, error_trace string"
)
ATTEMPTS = T.StructType(
    [
        *S.struct("task_id string, state string, result string"),
        T.StructField("failure", S.FAILURE),
        *S.struct("attempt int"),
    ]
)
COMMIT_PER_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@dataclass(frozen=True)
class Ok:
    """A successful result; the value must be JSON-compatible."""

    value: Any = None


@dataclass(frozen=True)
class Err:
    """A failed result with its reason."""

    reason: Any


@dataclass(frozen=True)
class Context:
    """What a task function sees of its run."""

    task_id: str
    task_name: str
    attempt: int


@dataclass(frozen=True)
class Task:
    """A registered function with its defaults."""

    name: str
    run: Callable[[Any, Context], Ok | Err]
    queue: str | None = None
    max_attempts: int | None = None
    max_delay_s: int | None = None
    max_duration_s: int | None = None
    retry: tuple[str, float, float | None, float | None] | None = None
    batch: bool = False

    def __call__(self, params: Any, context: Context) -> Ok | Err:
        return self.run(params, context)


class ConfigurationError(ValueError):
    """A task or registry that cannot be used."""


def task(
    *,
    name: str,
    queue: str | None = None,
    max_attempts: int | None = None,
    max_delay_s: int | None = None,
    max_duration_s: int | None = None,
    retry: tuple[str, float, float | None, float | None] | None = None,
    batch: bool = False,
) -> Callable[[Callable], Task]:
    """Register ``fn(params, context) -> Ok | Err`` under a durable name.

    With ``batch`` the function is ``fn(rows) -> Series`` instead: it gets a frame of many rows
    with ``task_id``, ``attempt`` and JSON ``params`` and returns the JSON results in their
    order. ``retry`` is (kind, base seconds, factor, most seconds), for ``run_due``.
    """
    if not isinstance(name, str) or not name.strip():
        raise ConfigurationError("a task name must be a non-empty string")
    if queue is not None and not 0 < len(queue.encode()) <= S.MAX_QUEUE_BYTES:
        raise ConfigurationError(f"a queue name has 1 to {S.MAX_QUEUE_BYTES} bytes")
    if max_attempts is not None and not (type(max_attempts) is int and max_attempts > 0):
        raise ConfigurationError("max_attempts must be a positive integer")
    for seconds in (max_delay_s, max_duration_s):
        if seconds is not None and not (type(seconds) is int and seconds >= 0):
            raise ConfigurationError("cancellation limits are whole seconds from zero")
    if retry is not None and (len(retry) != 4 or retry[0] not in RETRY_KINDS):
        raise ConfigurationError(f"retry is (kind, base, factor, most) with a kind of {RETRY_KINDS}")
    return lambda fn: Task(
        name, fn, queue, max_attempts, max_delay_s, max_duration_s, retry, batch
    )


class Registry:
    """The tasks of one queue by durable name."""

    def __init__(self, tasks: Iterable[Task], queue: str):
        self.queue = queue
        self.tasks: dict[str, Task] = {}
        for entry in tasks:
            if not isinstance(entry, Task):
                raise ConfigurationError(f"not a task: {entry!r}")
            if entry.queue not in (None, queue):
                raise ConfigurationError(f"{entry.name} belongs to {entry.queue}, not {queue}")
            if entry.name in self.tasks:
                raise ConfigurationError(f"duplicate durable task name {entry.name}")
            self.tasks[entry.name] = entry

    def __len__(self) -> int:
        return len(self.tasks)

    def catalog(self, spark: SparkSession) -> DataFrame:
        """The registrations as a table."""
        rows = [
            (self.queue, t.name, t.run.__qualname__, t.max_attempts, t.max_delay_s,
             t.max_duration_s)
            for t in self.tasks.values()
        ]
        return spark.createDataFrame(rows, CATALOG)

    def options(self, spark: SparkSession) -> DataFrame:
        """Limits and retry strategy of each name, as a table."""
        rows = [
            (t.name, t.max_attempts or S.DEFAULT_MAX_ATTEMPTS, t.max_delay_s, t.max_duration_s, t.retry)
            for t in self.tasks.values()
        ]
        schema = S.struct("task_name string, max_attempts int, max_delay_s long, max_duration_s long")
        return spark.createDataFrame(rows, schema.add("retry_strategy", S.RETRY_STRATEGY))


def _error(name: str, message: Any, trace: str | None = None) -> tuple:
    text = message if isinstance(message, str) else repr(message)
    return ("failed", None, name, text, trace)


def _outcome(run: Callable[[], Ok | Err]) -> tuple:
    """State, result and error fields of one call."""
    try:
        returned = run()
        if isinstance(returned, Ok):
            return ("completed", json.dumps(returned.value, allow_nan=False), None, None, None)
        if isinstance(returned, Err):
            return _error("TaskError", returned.reason)
        return _error("RuntimeError", f"task returned {returned!r}; neither Ok nor Err")
    except Exception as error:
        return _error(type(error).__name__, str(error), traceback.format_exc())


def _called_in_batch(rows: pd.DataFrame, execute: Callable[[pd.DataFrame], Any]) -> list[tuple]:
    """Outcomes of one call for many rows; a batch that fails is halved, so bad rows fail alone."""
    try:
        results = list(execute(rows))
        if len(results) != len(rows):
            raise RuntimeError(f"batch task returned {len(results)} results for {len(rows)} rows")
        wrong = [r for r in results if not (r is None or isinstance(r, str))]
        if wrong:
            raise RuntimeError(f"batch task returned {wrong[0]!r}; neither JSON text nor None")
        return [("completed", "null" if r is None else r, None, None, None) for r in results]
    except Exception as error:
        if len(rows) == 1:
            return [_error(type(error).__name__, str(error), traceback.format_exc())]
        half = len(rows) // 2
        return _called_in_batch(rows.iloc[:half], execute) + _called_in_batch(rows.iloc[half:], execute)


def run_tasks(
    runs: DataFrame,
    registry: Registry,
    wrap: Callable[[Context, Callable[[], Ok | Err]], Ok | Err] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Call each run's task once: completed with a JSON result, failed, or deferred.

    ``runs`` has task_id, task_name, attempt and JSON ``params``. A name that is not
    registered is deferred. ``wrap(context, execute)`` brackets every call; for a batch function
    the context is a frame of its rows. A batch function is called once for all its rows of an
    Arrow batch; if that fails, for its halves, so a bad row fails alone and the rest completes.
    ``partitions`` spreads slow functions evenly, whatever the files look like. The result is
    lazy; write it once before reading it twice.
    """
    tasks = registry.tasks

    def call(row) -> tuple:
        entry = tasks.get(row.task_name)
        if entry is None:
            return ("deferred", None, None, None, None)
        context = Context(row.task_id, row.task_name, int(row.attempt))

        def execute() -> Ok | Err:
            return entry(None if row.params is None else json.loads(row.params), context)

        return _outcome(execute if wrap is None else lambda: wrap(context, execute))

    def call_batch(entry: Task, rows: pd.DataFrame) -> list[tuple]:
        own = rows[["task_id", "attempt", "params"]]
        found = _called_in_batch(
            own, lambda part: entry.run(part) if wrap is None else wrap(part, lambda: entry.run(part))
        )
        return [(t, a, *outcome) for t, a, outcome in zip(own.task_id, own.attempt, found)]

    batched = {name for name, entry in tasks.items() if entry.batch}

    def run(batches):
        for batch in batches:
            whole = batch.task_name.isin(batched)
            done = [(r.task_id, r.attempt, *call(r)) for r in batch[~whole].itertuples(index=False)]
            for name, rows in batch[whole].groupby("task_name"):
                done += call_batch(tasks[name], rows)
            yield pd.DataFrame(done, columns=OUTCOMES.names)

    # Rows from an outer join carry a plain None, not NaN, in string columns.
    wanted = runs.select("task_id", "task_name", F.col("attempt").cast("int"), "params")
    if partitions:
        wanted = wanted.repartition(partitions)
    failure = failure_record(F.col("error_name"), F.col("error_message"), F.col("error_trace"))
    return wanted.mapInPandas(run, OUTCOMES).select(
        "task_id",
        "state",
        "result",
        F.when(F.col("state") == "failed", failure).alias("failure"),
        "attempt",
    )


def attempts_made(spark: SparkSession, store: str) -> DataFrame:
    """Attempt rows of a store, one per (task, attempt)."""
    return _one_per_attempt(read_or_empty(spark, store, ATTEMPTS))


def _one_per_attempt(rows: DataFrame) -> DataFrame:
    kept = F.min(F.struct("state", "result", "failure")).alias("_row")
    return rows.groupBy("task_id", "attempt").agg(kept).select("task_id", "attempt", "_row.*")


def run_with_retries(
    runs: DataFrame,
    registry: Registry,
    store: str,
    wrap: Callable | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Run tasks until they complete or use up their attempts; the last attempt of each.

    Each round runs only what has no row in ``store`` yet: new runs, then those whose
    previous attempt failed. A second call with the same store calls no function again.
    Unregistered names are deferred and use no attempt.
    """
    spark = runs.sparkSession
    limits = {t.name: t.max_attempts or S.DEFAULT_MAX_ATTEMPTS for t in registry.tasks.values()}
    for number in range(1, max(limits.values(), default=0) + 1):
        made = read_or_empty(spark, store, ATTEMPTS)
        allowed = [name for name, limit in limits.items() if limit >= number]
        todo = runs.where(F.col("task_name").isin(allowed))
        if number > 1:
            # An attempt that a rerun wrote twice counts as completed if one of its rows does.
            before = _one_per_attempt(made.where(F.col("attempt") == number - 1))
            failed = before.where(F.col("state") == "failed")
            if failed.isEmpty():
                break
            todo = todo.join(failed.select("task_id"), "task_id", "left_semi")
        here = made.where(F.col("attempt") == number).select("task_id")
        todo = todo.join(here, "task_id", "left_anti").withColumn("attempt", F.lit(number))
        done = run_tasks(todo, registry, wrap, partitions)
        done.write.mode("append").options(**COMMIT_PER_TASK).partitionBy("attempt").parquet(store)
    last = F.max_by(F.struct("attempt", "state", "result", "failure"), "attempt").alias("_last")
    outcome = attempts_made(spark, store).groupBy("task_id").agg(last)
    return runs.join(outcome, "task_id", "left").select(
        *runs.columns,
        F.coalesce("_last.attempt", F.lit(1)).alias("attempt"),
        F.coalesce("_last.state", F.lit("deferred")).alias("state"),
        "_last.result",
        "_last.failure",
    )


DUE = T.StructType([*ATTEMPTS.fields, *S.struct("started_at timestamp, wake_at timestamp")])


def run_due(
    runs: DataFrame,
    registry: Registry,
    store: str,
    now: datetime,
    wrap: Callable | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Run what is due at ``now``, and say where every run stands then.

    ``runs`` has task_id, task_name, JSON ``params`` and ``spawned_at``. An attempt that fails at
    a time wakes after its task's retry delay; before that a call runs it no more. A run whose
    cancellation limits (most delay before the start, longest duration after it) have passed
    ends cancelled instead. Attempts, their start and wake times are rows of ``store``, so
    calls may be minutes or days apart, a lost job loses only its unfinished tasks, and a call
    at the same time runs nothing twice. Unregistered names are deferred.
    """
    spark = runs.sparkSession
    at = F.lit(now).cast("timestamp")
    options = registry.options(spark)

    def standing() -> DataFrame:
        made = read_or_empty(spark, store, DUE)
        # An attempt that a rerun wrote twice counts as completed if one of its rows does.
        once = made.groupBy("task_id", "attempt").agg(
            F.min(F.struct("state", "result", "failure", "started_at", "wake_at")).alias("_row")
        )
        last = once.groupBy("task_id").agg(
            F.max_by(F.struct("attempt", "_row"), "attempt").alias("_last"),
            F.min("_row.started_at").alias("_first"),
        )
        return runs.join(options, "task_name", "left").join(last, "task_id", "left")

    most = max((t.max_attempts or S.DEFAULT_MAX_ATTEMPTS for t in registry.tasks.values()), default=0)
    made = F.coalesce("_last.attempt", F.lit(0))
    again = (F.col("_last._row.state") == "failed") & (made < F.col("max_attempts"))
    live = F.col("max_attempts").isNotNull() & (F.col("_last").isNull() | again)
    deadline = cancellation_deadline(
        F.col("spawned_at").cast("timestamp"), F.col("_first"), F.col("max_delay_s"),
        F.col("max_duration_s"),
    )
    over = F.coalesce(deadline <= at, F.lit(False))
    due = live & ~over & F.coalesce(F.col("_last._row.wake_at") <= at, F.lit(True))

    def append(rows: DataFrame) -> None:
        rows.select(*DUE.names).write.mode("append").options(**COMMIT_PER_TASK).partitionBy(
            "attempt"
        ).parquet(store)

    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in DUE}
    cancelled = standing().where(live & over).select(
        "task_id", (made + 1).alias("attempt"), F.lit("cancelled").alias("state"), none["result"],
        none["failure"], none["started_at"], none["wake_at"],
    )
    append(cancelled)
    # Without a delay the next attempt is due at once, so as many rounds as attempts at most.
    for _ in range(most):
        todo = standing().where(due).select(
            "task_id", "task_name", "params", (made + 1).alias("attempt"), "retry_strategy"
        )
        if todo.isEmpty():
            break
        delay = strategy_delay("retry_strategy", F.col("attempt"))
        wakes = todo.select("task_id", after(at, delay).alias("_wake"))
        done = run_tasks(todo.drop("retry_strategy"), registry, wrap, partitions)
        append(
            done.join(wakes, "task_id").select(
                *ATTEMPTS.names, at.alias("started_at"),
                F.when(F.col("state") == "failed", F.col("_wake")).alias("wake_at"),
            )
        )
    asleep = F.col("_last._row.state") == "failed"
    return standing().select(
        *runs.columns,
        made.alias("attempt"),
        F.when(F.col("max_attempts").isNull(), "deferred")
        .when(F.col("_last").isNull(), "pending")
        .when(asleep & (made < F.col("max_attempts")), "sleeping")
        .otherwise(F.col("_last._row.state"))
        .alias("state"),
        F.col("_last._row.result").alias("result"),
        F.col("_last._row.failure").alias("failure"),
        F.when(asleep & (made < F.col("max_attempts")), F.col("_last._row.wake_at")).alias("wake_at"),
    )


def durable_step(
    rows: DataFrame,
    name: str,
    step: Callable[[Any, Context], Ok | Err],
    store: str,
    attempt: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Map ``params`` through a function whose successes are kept under ``name``.

    Rows with a committed checkpoint take its value and are not run; failed rows leave
    none and run again next time. Adds ``checkpoint_name``, ``value`` and ``done``. A lost
    job loses only its unfinished tasks, so more ``partitions`` keep more of it.
    """
    spark = rows.sparkSession
    steps = rows.withColumn("checkpoint_name", F.lit(name))
    known = read_or_empty(spark, store, S.CHECKPOINTS).where(F.col("checkpoint_name") == name)
    committed = known.where(F.col("status") == "committed").select("task_id")
    todo = steps.join(committed, "task_id", "left_anti").select(
        "task_id", F.lit(name).alias("task_name"), F.lit(attempt).alias("attempt"), "params"
    )
    done = run_tasks(todo, Registry([Task(name, step)], name), partitions=partitions)
    kept = F.when(F.col("state") == "completed", F.col("result")).otherwise(F.to_json("failure"))
    status = F.when(F.col("state") == "completed", "committed").otherwise("failed")
    checkpoints = done.select(
        "task_id",
        kept.alias("state"),
        F.md5(F.concat_ws(":", F.lit(name), "task_id", "attempt")).alias("owner_run_id"),
        F.current_timestamp().alias("updated_at"),
        F.lit(name).alias("checkpoint_name"),
        status.alias("status"),
    )
    (
        checkpoints.write.mode("append")
        .options(**COMMIT_PER_TASK)
        .partitionBy("checkpoint_name", "status")
        .parquet(store)
    )
    stored = read_or_empty(spark, store, S.CHECKPOINTS).where(F.col("checkpoint_name") == name)
    return replay(steps, stored)
