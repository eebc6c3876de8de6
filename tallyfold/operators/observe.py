"""Spans, throughput, leases and active runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import bounded_text
from tallyfold.functions.timing import after, seconds_between
from tallyfold.plans import ROWS_PER_SEGMENT, windowed

SAFE_COLUMNS = ["queue", "task_name", "task_id", "run_id", "attempt", "op", "ts"]
SAFE_NAME_BYTES = 128


def pair_spans(spans: DataFrame) -> DataFrame:
    """One row per span: start with its stop or exception; without one it is open."""
    starts = F.col("phase") == "start"
    start_at = F.when(starts, F.col("ts"))
    end = F.when(~starts, F.struct("ts", "phase", "outcome", "error_kind"))
    paired = spans.groupBy("span_id").agg(
        F.min_by(F.struct("component", "operation"), start_at).alias("_what"),
        F.min(start_at).alias("started_at"),
        F.min(end).alias("_end"),
    )
    outcome = (
        F.when(F.col("_end").isNull(), "open")
        .when(F.col("_end.phase") == "exception", "exception")
        .otherwise(F.coalesce("_end.outcome", F.lit("success")))
    )
    return paired.where(F.col("started_at").isNotNull()).select(
        "span_id",
        "_what.*",
        "started_at",
        F.col("_end.ts").alias("ended_at"),
        seconds_between(F.col("started_at"), F.col("_end.ts")).alias("duration_s"),
        outcome.alias("outcome"),
        F.col("_end.error_kind").alias("error_kind"),
    )


def span_statistics(spans: DataFrame, percentages: tuple[float, ...] = (0.5, 0.95, 0.99)):
    """Count, total and percentiles of the duration per operation, outcome and error kind.

    The total is rounded to microseconds, below which it depends on the order of summing.
    """
    cuts = F.percentile_approx("duration_s", list(percentages))
    stats = spans.groupBy("operation", "outcome", "error_kind").agg(
        F.count(F.lit(1)).alias("spans"),
        F.round(F.sum("duration_s"), 6).alias("total_s"),
        F.max("duration_s").alias("max_s"),
        cuts.alias("_cuts"),
    )
    names = [f"p{round(p * 100)}_s" for p in percentages]
    picked = [F.col("_cuts")[i].alias(name) for i, name in enumerate(names)]
    return stats.select("*", *picked).drop("_cuts")


def throughput(completed: DataFrame) -> DataFrame:
    """Completed rows per second of the elapsed time, per queue."""
    totals = completed.groupBy("queue").agg(
        F.count(F.lit(1)).alias("completed"),
        F.min("ended_at").alias("first_at"),
        F.max("ended_at").alias("last_at"),
    )
    elapsed = seconds_between(F.col("first_at"), F.col("last_at"))
    rate = F.try_divide(F.col("completed"), elapsed)
    return totals.withColumns({"elapsed_s": elapsed, "per_second": rate})


def hourly_throughput(completed: DataFrame) -> DataFrame:
    """Completed rows per queue and hour."""
    hour = F.date_trunc("hour", F.col("ended_at")).cast("timestamp_ntz")
    return completed.groupBy("queue", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("completed")
    )


def lease_status(
    beats: DataFrame, now: Column, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """How long each confirmed lease went without an extension.

    Past one lease duration is a warning, past two the lease has expired. The age ends at
    the next extension, at the end of the run, or at ``now``.
    """
    rows = windowed(
        beats.where(F.col("ts") <= now),
        ["run_id"],
        ["ts", "seq"],
        leads={"_next": F.col("ts")},
        rows_per_segment=rows_per_segment,
    )
    until = F.coalesce("_next", "run_ended_at", now)
    age = seconds_between(F.col("ts"), until)
    status = (
        F.when(age >= 2 * F.col("lease_s"), "expired")
        .when(age >= F.col("lease_s"), "warning")
        .otherwise("ok")
    )
    return rows.select(
        *beats.columns,
        until.alias("until"),
        age.alias("age_s"),
        status.alias("status"),
        after(F.col("ts"), F.col("lease_s")).alias("warning_at"),
        after(F.col("ts"), 2 * F.col("lease_s")).alias("expires_at"),
    )


def active_runs(
    runs: DataFrame,
    capacity: int,
    keys: list[str] | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Active runs and free capacity after every change; an end frees its slot first.

    Starts and ends at the same instant are summed before the running total, which also
    spreads over tasks when ``keys`` is empty and the whole table is one group.
    """
    keys = ["queue"] if keys is None else keys
    points = F.array(
        F.struct(F.col("started_at").alias("at"), F.lit(1).alias("change")),
        F.struct(F.col("ended_at").alias("at"), F.lit(-1).alias("change")),
    )
    changes = (
        runs.select(*keys, F.explode(points).alias("_p"))
        .where(F.col("_p.at").isNotNull())
        .groupBy(*keys, F.col("_p.at").alias("changed_at"))
        .agg(F.sum("_p.change").alias("change"))
    )
    rows = windowed(
        changes,
        keys,
        ["changed_at"],
        sums={"active": F.col("change")},
        rows_per_segment=rows_per_segment,
    )
    return rows.withColumn("free", F.greatest(F.lit(capacity) - F.col("active"), F.lit(0)))


def safe_projection(transitions: DataFrame) -> DataFrame:
    """Only columns that may be logged: no payload, no headers, names cut to 128 bytes."""
    bounded = bounded_text(F.col("task_name"), SAFE_NAME_BYTES).alias("task_name")
    return transitions.select(*[bounded if c == "task_name" else c for c in SAFE_COLUMNS])
