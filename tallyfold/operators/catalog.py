"""Registered task names: lookup, option precedence, routing and deferral."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.text import unknown_task_delay
from tallyfold.functions.timing import after


def lookup(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog columns for each run by durable name; ``registered`` says whether it has them.

    No broadcast hint: Spark broadcasts a catalog below its size threshold by itself and
    splits hot names of a larger one.
    """
    known = catalog.withColumn("registered", F.lit(True))
    joined = runs.join(known, ["queue", "task_name"], "left")
    return joined.withColumn("registered", F.coalesce("registered", F.lit(False)))


def defer_unknown(runs: DataFrame, catalog: DataFrame, now: Column) -> DataFrame:
    """Runs whose name is not registered, with the time to try again; no attempt is used."""
    names = catalog.select("queue", "task_name")
    unknown = runs.join(names, ["queue", "task_name"], "left_anti")
    delay = unknown_task_delay(F.col("run_id"))
    return unknown.withColumns({"delay_s": delay, "wake_at": after(now, delay)})


def _registered(requests: DataFrame, catalog: DataFrame, default_queue: str) -> DataFrame:
    """Requests with ``_registered``, the queue that counts for their name, and its defaults.

    ``_queues`` is how many queues register the name. With one, that is the queue; with several
    the request's own, else the client's. A request matches one registration at most.
    """
    queue = F.coalesce("catalog_queue", F.lit(default_queue))
    options = [c for c in catalog.columns if c.startswith("default_")]
    known = (
        catalog.groupBy("task_name", queue.alias("_registered"))
        .agg(*(F.max(c).alias(c) for c in options), F.max(F.lit(1)).alias("_one"))
        .drop("_one")
    )
    names = known.groupBy("task_name").agg(
        F.count(F.lit(1)).alias("_queues"), F.min("_registered").alias("_first_queue")
    )
    counted = requests.join(names, "task_name", "left").withColumn(
        "_registered",
        F.when(F.col("_queues") == 1, F.col("_first_queue")).when(
            F.col("_queues") > 1, F.coalesce("queue", F.lit(default_queue))
        ),
    )
    found = known.withColumn("_found", F.lit(True))
    return counted.join(found, ["task_name", "_registered"], "left").withColumn(
        "_registered", F.when(F.col("_found"), F.col("_registered"))
    )


def resolve_options(
    requests: DataFrame,
    catalog: DataFrame,
    default_max_attempts: int = S.DEFAULT_MAX_ATTEMPTS,
    default_queue: str = "default",
) -> DataFrame:
    """Fill omitted options: the request wins, then the task's own default, then the client's.

    Of a name that several queues register, the request's queue decides, then the client's.
    """
    joined = _registered(requests, catalog, default_queue)
    return joined.select(
        *requests.columns,
        F.coalesce("max_attempts", "default_max_attempts", F.lit(default_max_attempts)).alias(
            "resolved_max_attempts"
        ),
        F.coalesce("max_delay_s", "default_max_delay_s").alias("resolved_max_delay_s"),
        F.coalesce("max_duration_s", "default_max_duration_s").alias("resolved_max_duration_s"),
    )


def route(requests: DataFrame, catalog: DataFrame, default_queue: str) -> DataFrame:
    """Destination of each request, or why it is refused.

    A registered name belongs to the queues that register it, the client's where it names
    none, and an override must be one of them; of several without an override the client's
    counts. A raw name needs an explicit queue. Every request gets one answer.
    """
    joined = _registered(requests, catalog, default_queue)
    known, own = F.col("_queues").isNotNull(), F.col("_registered")
    mismatch = known & F.col("queue").isNotNull() & ~F.coalesce(F.col("queue") == own, F.lit(False))
    reason = (
        F.when(~known & F.col("queue").isNull(), "queue_required")
        .when(mismatch, "queue_mismatch")
        .when(known & own.isNull(), "queue_required")
    )
    return joined.select(
        *requests.columns,
        F.when(reason.isNull(), F.coalesce("_registered", "queue")).alias("routed_queue"),
        reason.alias("reason"),
    )


def duplicate_names(registrations: DataFrame) -> DataFrame:
    """Durable names that a queue registers more than once.

    The callables are counted and the first and last named; they are not gathered, since a
    name may be registered any number of times.
    """
    return (
        registrations.groupBy("queue", "task_name")
        .agg(
            F.count(F.lit(1)).alias("registrations"),
            F.min("callable").alias("first_callable"),
            F.max("callable").alias("last_callable"),
        )
        .where(F.col("registrations") > 1)
    )


def catalog_size(registrations: DataFrame) -> DataFrame:
    """Registered names per queue."""
    names = registrations.select("queue", "task_name").distinct()
    return names.groupBy("queue").agg(F.count(F.lit(1)).alias("names"))
