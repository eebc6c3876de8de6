"""First-wins events, idempotent submits, terminal results, spans and snapshots on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.operators.fold import TASK, accumulate, merge, show
from tallyfold.operators.history import is_terminal
from tallyfold.operators.writes import submit
from tallyfold.plans.ranges import covering
from tallyfold.session import read_or_empty, written
from tallyfold.sources.keys import KeyTable
from tallyfold.streaming.state import (
    batch_before,
    cached_batch,
    clock_span,
    write_batch,
)

EVENT_KEY = ["queue", "event_name"]


def first_arrivals(events: DataFrame, ttl: str | None = None, salts: int = 16) -> DataFrame:
    """The first event of each name to arrive; with ``ttl`` names are forgotten after it.

    Rows are first reduced per salt of a name, so a hot name reaches the last step with at
    most ``salts`` rows.
    """
    salted = events.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(salts)))
    per_salt = [*EVENT_KEY, "_salt"]
    if ttl is None:
        return salted.dropDuplicates(per_salt).dropDuplicates(EVENT_KEY).drop("_salt")
    marked = salted.withWatermark("emitted_at", ttl)
    reduced = marked.dropDuplicatesWithinWatermark(per_salt)
    return reduced.dropDuplicatesWithinWatermark(EVENT_KEY).drop("_salt")


def first_events_running(events: DataFrame) -> DataFrame:
    """The earliest event of each name so far; for update or complete mode.

    An aggregate combines a hot name before the shuffle, which deduplication does not.
    """
    at = F.struct("emitted_at", "seq")
    return events.groupBy(*EVENT_KEY).agg(
        F.min_by("payload", at).alias("payload"), F.min("emitted_at").alias("emitted_at")
    )


def terminal_results(snapshots: DataFrame, wanted: DataFrame) -> DataFrame:
    """Terminal results of the wanted tasks as they appear; ``wanted`` is a static table."""
    ended = snapshots.where(is_terminal(F.col("state")))
    return ended.join(wanted.select(*TASK).distinct(), TASK)


def span_metrics(spans: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Count, total, largest and median duration per operation, outcome and window."""
    return (
        spans.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "operation", "outcome")
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.round(F.sum("duration_s"), 6).alias("total_s"),
            F.max("duration_s").alias("max_s"),
            F.percentile_approx("duration_s", 0.5).alias("median_s"),
        )
        .select(
            F.col("window.start").alias("started_at"),
            "operation",
            "outcome",
            "spans",
            "total_s",
            "max_s",
            "median_s",
        )
    )


def submit_batches(store: str, buckets: int = 16):
    """A ``foreachBatch`` function that spawns idempotently and keeps the tasks in ``store``.

    Every batch writes its own folder, so a batch that runs again replaces its own rows. The
    keys that earlier batches took lie in a bucketed table below ``store``: a batch looks up
    its own keys only, and shuffles none of the stored ones.
    """
    schema = S.struct(
        "request_id string, queue string, idempotency_key string, task_id string, "
        "run_id string, attempt int"
    )

    @cached_batch
    def run(batch: DataFrame, batch_id: int) -> None:
        key = ["queue", "idempotency_key"]
        taken = KeyTable(batch.sparkSession, f"{store}/_keys", schema, key, buckets)
        known = written(taken.find(batch, batch_id - 1), "taken-keys")
        spawned = submit(known, batch)
        write_batch(spawned.where("created").select(*schema.names), store, batch_id)
        own = batch.sparkSession.read.schema(schema).parquet(f"{store}/batch={batch_id}")
        taken.append(own, batch_id)

    return run


def _folder(store: str, first: int, last: int) -> str:
    return f"{store}/folded/last={last}/first={first}"


def _folded(spark: SparkSession, store: str, ranges, details: bool) -> DataFrame:
    schema = accumulate(spark.createDataFrame([], S.TRANSITIONS), details).schema
    empty = [spark.createDataFrame([], schema)]
    return merge(*empty, *[spark.read.schema(schema).parquet(_folder(store, *r)) for r in ranges])


def snapshot_batches(store: str, late_s: int = 600, details: bool = False):
    """A ``foreachBatch`` function that folds a history stream into ``store``.

    Rows wait until the clock, the newest time seen less ``late_s``, has passed them; the rows
    that it passed since the batch before are accumulated and merged with the folders that the
    batch number completes, so a batch costs the same early and late in a stream's life and
    rows of a task may come in any order within ``late_s``. Rows older than the clock was go
    to ``late`` and have no effect; ``late_rows`` reads them. Read the state with
    ``latest_snapshot``.
    """
    schema = S.TRANSITIONS

    @cached_batch
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, now = clock_span(batch, "ts", f"{store}/clock", batch_id, late_s)
        waiting = batch_before(spark, f"{store}/recent", batch_id, schema)
        new = batch.select(*schema.names)
        write_batch(new.where(F.col("ts") <= before), f"{store}/late", batch_id)
        rows = waiting.unionByName(new.where(F.col("ts") > before))
        write_batch(rows.where(F.col("ts") > now), f"{store}/recent", batch_id)
        own = accumulate(rows.where(F.col("ts") <= now), details)
        first, last = covering(batch_id)[-1]
        # The part before this batch that the new folder replaces.
        parts = [r for r in covering(batch_id - 1) if r[0] >= first]
        if parts:
            own = merge(_folded(spark, store, parts, details), own)
        own.write.mode("overwrite").parquet(_folder(store, first, last))

    return run


def latest_snapshot(
    spark: SparkSession, store: str, batch_id: int, details: bool = False
) -> DataFrame:
    """The folded state after one batch, rows that still wait for the clock included."""
    recent = read_or_empty(spark, f"{store}/recent/batch={batch_id}", S.TRANSITIONS)
    settled = _folded(spark, store, covering(batch_id), details)
    return show(merge(settled, accumulate(recent, details)), details)


def late_rows(spark: SparkSession, store: str) -> DataFrame:
    """Rows that came more than the allowed lateness after newer ones, and so have no effect."""
    return read_or_empty(spark, f"{store}/late", S.copy_of(S.TRANSITIONS).add("batch", "long"))
