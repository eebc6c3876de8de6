"""Event waits, child results and result lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.timing import after
from tallyfold.operators.history import first_events, is_terminal, until


def resolve_waits(waits: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """Each wait is resolved by the first event of its name, timed out, or still sleeping.

    The event may precede the wait. An event at the deadline comes too late; a null
    timeout never ends. Rows after ``now`` are not visible yet.
    """
    return decide(until(waits, now, "wait_ts"), first_events(events, now), now)


def decide(waits: DataFrame, first: DataFrame, now: Column) -> DataFrame:
    """Status, payload and time of each wait, given one event per (queue, event_name)."""
    known = first.select("queue", "event_name", "payload", F.col("emitted_at").alias("_event_at"))
    joined = waits.join(known, ["queue", "event_name"], "left")
    deadline = after(F.col("wait_ts"), F.col("timeout_s"))
    open_ended = F.col("timeout_s").isNull()
    met = F.col("_event_at").isNotNull() & (open_ended | (F.col("_event_at") < deadline))
    met = F.coalesce(met, F.lit(False))
    expired = ~open_ended & (deadline <= now)
    return joined.select(
        *waits.columns,
        F.when(met, "resolved").when(expired, "timed_out").otherwise("sleeping").alias("status"),
        F.when(met, F.col("payload")).alias("payload"),
        F.when(met, F.greatest("wait_ts", "_event_at"))
        .when(expired, deadline)
        .alias("resolved_at"),
    )


def child_results(parents: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The child's terminal state for each waiting parent, or why there is none.

    A parent may not wait for a child in its own queue: the two could block each other.
    """
    child = snapshot.select(
        F.col("queue").alias("child_queue"),
        F.col("task_id").alias("child_id"),
        F.col("state").alias("_state"),
        "result",
        "failure",
    )
    joined = parents.join(child, ["child_queue", "child_id"], "left")
    same = F.col("queue") == F.col("child_queue")
    ended = is_terminal(F.col("_state")) & ~same
    status = (
        F.when(same, "same_queue")
        .when(F.col("_state").isNull(), "unknown")
        .when(is_terminal(F.col("_state")), F.col("_state"))
        .otherwise("waiting")
    )
    return joined.select(
        *parents.columns,
        status.alias("status"),
        F.when(ended, F.col("result")).alias("result"),
        F.when(ended, F.col("failure")).alias("failure"),
    )


def fetch_results(snapshot: DataFrame, ids: DataFrame) -> DataFrame:
    """Snapshot columns for the wanted (queue, task_id); null where the task is unknown."""
    wanted = snapshot.select("queue", "task_id", "state", "result", "failure")
    return ids.join(wanted, ["queue", "task_id"], "left")


def results_by_reference(references: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Results by spawn reference; an override of the carried queue must equal it."""
    mismatch = F.coalesce(F.col("queue_override") != F.col("queue"), F.lit(False))
    found = fetch_results(snapshot, references)
    status = (
        F.when(mismatch, "queue_mismatch")
        .when(F.col("state").isNull(), "unknown")
        .otherwise(F.col("state"))
    )
    return found.select(
        *references.columns,
        status.alias("status"),
        F.when(~mismatch, F.col("result")).alias("result"),
        F.when(~mismatch, F.col("failure")).alias("failure"),
    )
