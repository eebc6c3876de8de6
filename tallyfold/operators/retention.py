"""Bounded cleanup, queue policies and partition upkeep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.timing import seconds_interval
from tallyfold.operators.history import is_terminal
from tallyfold.plans import top_per_group
from tallyfold.plans.topk import SALTED_MOST
from tallyfold.session import written


def interval_seconds(text: Column, at: Column) -> Column:
    """Length of an interval string at ``at``; a calendar interval has no length of its own."""
    start = at.cast("timestamp_ntz")
    micros = [
        F.unix_micros(c.cast("timestamp")) for c in (start, start + text.try_cast("interval"))
    ]
    return (micros[1] - micros[0]) / F.lit(1e6)


def expired_tasks(snapshot: DataFrame, now: Column, ttl_s: Column) -> DataFrame:
    cutoff = now - seconds_interval(ttl_s)
    return snapshot.where(is_terminal(F.col("state")) & (F.col("ended_at") < cutoff))


def cleanup_tasks(
    snapshot: DataFrame, now: Column, ttl_s: int, limit: int = S.DEFAULT_CLEANUP_LIMIT
) -> DataFrame:
    """Terminal tasks older than the ttl to delete, oldest first, at most ``limit`` per queue."""
    old = expired_tasks(snapshot, now, F.lit(ttl_s))
    return top_per_group(old, ["queue"], ["ended_at", "task_id"], limit, rank="place")


def cleanup_events(
    events: DataFrame, now: Column, ttl_s: int, limit: int = S.DEFAULT_CLEANUP_LIMIT
) -> DataFrame:
    """Events older than the ttl to delete, oldest first, at most ``limit`` per queue."""
    old = events.where(F.col("emitted_at") < now - seconds_interval(F.lit(ttl_s)))
    order = ["emitted_at", "event_name", "seq"]
    return top_per_group(old, ["queue"], order, limit, rank="place")


def survivors(table: DataFrame, deleted: DataFrame, keys: list[str]) -> DataFrame:
    """What stays after a cleanup.

    The deleted keys are bounded by the limit and are written first, so that Spark knows
    their size and spares the large side a shuffle when they are small.
    """
    gone = written(deleted.select(*keys), "deleted")
    return table.join(gone, keys, "left_anti")


def cleanup_counts(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """Deleted tasks and events per queue."""
    by_task = tasks.groupBy("queue").agg(F.count(F.lit(1)).alias("tasks_deleted"))
    by_event = events.groupBy("queue").agg(F.count(F.lit(1)).alias("events_deleted"))
    joined = by_task.join(by_event, "queue", "full")
    return joined.na.fill(0, ["tasks_deleted", "events_deleted"])


def cleanup_all(
    snapshot: DataFrame,
    events: DataFrame,
    policies: DataFrame,
    now: Column,
    queue: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Tasks and events to delete under each queue's own ttl and limit.

    Queues with a limit above ``SALTED_MOST`` are ranked on their own, so that one of them
    does not change how the others are cut.
    """
    chosen = policies if queue is None else policies.where(F.col("queue") == queue)
    rules = chosen.where(F.col("cleanup_ttl").isNotNull()).select(
        "queue",
        (now.cast("timestamp_ntz") - F.col("cleanup_ttl").cast("interval")).alias("_cutoff"),
        F.coalesce("cleanup_limit", F.lit(S.DEFAULT_CLEANUP_LIMIT)).alias("_limit"),
    )
    rules = written(rules, "rules")  # its size decides the join, and the histories stay put
    large = F.col("_limit") > SALTED_MOST
    most = rules.agg(
        F.max(F.when(~large, F.col("_limit"))), F.max(F.when(large, F.col("_limit")))
    ).first()
    groups = [(rules.where(~large), most[0] or 0)]
    if most[1] is not None:
        groups.append((rules.where(large), most[1]))

    def oldest(rows: DataFrame, at: str, order: list[str]) -> DataFrame:
        found = []
        for some, limit in groups:
            old = rows.join(some, "queue").where(F.col(at) < F.col("_cutoff"))
            found.append(top_per_group(old, ["queue"], order, limit, "place", own="_limit"))
        return reduce(DataFrame.unionByName, found).drop("_cutoff", "_limit")

    ended = snapshot.where(is_terminal(F.col("state")))
    return (
        oldest(ended, "ended_at", ["ended_at", "task_id"]),
        oldest(events, "emitted_at", ["emitted_at", "event_name", "seq"]),
    )


def upsert_policies(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Partial update: a field the update leaves null keeps its old value."""
    fields = [c for c in current.columns if c != "queue"]
    new = updates.select("queue", *[F.col(f).alias(f"_{f}") for f in fields])
    joined = current.join(new, "queue", "full")
    return joined.select("queue", *[F.coalesce(f"_{f}", f).alias(f) for f in fields])


def queue_policy(policies: DataFrame, queues: DataFrame) -> DataFrame:
    """The policy of each wanted queue; null fields where it has none."""
    return queues.join(policies, "queue", "left")


def list_queues(table: DataFrame) -> DataFrame:
    return table.select("queue").distinct().orderBy("queue")


def drop_queue(table: DataFrame, queues: DataFrame) -> DataFrame:
    """All rows but those of the dropped queues; unknown names are no error."""
    return table.join(written(queues.select("queue").distinct(), "queues"), "queue", "left_anti")


def partition_plan(policies: DataFrame, now: Column, existing: DataFrame) -> DataFrame:
    """Daily partitions from lookback to lookahead, and whether they exist already."""
    today = now.cast("timestamp_ntz")
    first = F.to_date(today - F.col("partition_lookback").cast("interval"))
    last = F.to_date(today + F.col("partition_lookahead").cast("interval"))
    wanted = policies.where(
        F.col("partition_lookback").isNotNull() & F.col("partition_lookahead").isNotNull()
    ).select("queue", F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("day"))
    have = existing.select("queue", "day", F.lit(True).alias("_have")).distinct()
    joined = wanted.join(have, ["queue", "day"], "left")
    return joined.select("queue", "day", F.col("_have").isNull().alias("missing"))


def detach_candidates(
    partitions: DataFrame, rows: DataFrame, policies: DataFrame, now: Column
) -> DataFrame:
    """Partitions past the minimum age that hold no rows, for queues that detach empty ones."""
    rules = policies.where(F.col("detach_mode") == "empty").select(
        "queue",
        F.to_date(now.cast("timestamp_ntz") - F.col("detach_min_age").cast("interval")).alias(
            "_oldest"
        ),
    )
    rules = written(rules, "rules")
    old = partitions.join(rules, "queue").where(F.col("day") < F.col("_oldest"))
    held = rows.select("queue", "day").distinct()
    return old.select("queue", "day").join(held, ["queue", "day"], "left_anti")
