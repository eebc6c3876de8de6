"""Questions to the append-only history: rejected writes, first events, attempts, replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.timing import cancellation_deadline, seconds_between
from tallyfold.operators.fold import (  # noqa: F401
    ORDER, TASK, before_each, ends_task, expire_leases, fold_state, is_legal, is_phase,
)
from tallyfold.plans import ROWS_PER_SEGMENT, top_per_group, windowed
from tallyfold.session import written

def is_terminal(state: Column) -> Column:
    return state.isin(*S.TERMINAL_STATES)


def until(df: DataFrame, as_of: Column | None, column: str = "ts") -> DataFrame:
    return df if as_of is None else df.where(F.col(column) <= as_of)


def rejected_writes(
    transitions: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Rows that the fold ignores, by the rule it has in common with the write operators.

    Those after the end of their generation have what ended it as ``ended_by`` and ``reason``,
    and the error code; releases of a task that was not running have ``not_running``.
    """
    position = F.struct(*ORDER)
    op = F.col("op")
    starts = op.isin(*S.GENERATION_OPS).cast("bigint")
    # Positions first: payloads and the like are fetched for the rejected rows alone.
    narrow = transitions.select(*TASK, *ORDER, "op", "attempt", "max_attempts")
    rows = before_each(narrow, rows_per_segment, sums={"generation": starts})
    rows = rows.where(F.col("generation") >= 1).withColumn(
        "_legal", is_legal(op, F.col("_before")) | ~is_phase(op)
    )
    ending = F.col("_legal") & ends_task(op, F.col("attempt"), F.col("max_attempts"))
    ends = (
        rows.where(ending)
        .groupBy(*TASK, "generation")
        .agg(F.min(position).alias("_end"), F.min_by("op", position).alias("ended_by"))
    )
    code = F.when(F.col("ended_by") == "cancel", S.CANCELLED_CODE).when(
        F.col("ended_by") == "fail", S.FAILED_CODE
    )
    late = F.coalesce(position > F.col("_end"), F.lit(False))
    joined = rows.join(ends, [*TASK, "generation"], "left").where(late | ~F.col("_legal"))
    found = joined.select(
        *TASK,
        *ORDER,
        "generation",
        F.when(late, F.col("ended_by")).alias("ended_by"),
        F.when(late, F.col("ended_by")).otherwise("not_running").alias("reason"),
        F.when(late, code).alias("code"),
    )
    # Written, so that its true size decides how the full rows are found.
    return transitions.join(written(found, "rejected"), [*TASK, *ORDER])


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """First request per (queue, key) creates the task; the others point to it.

    Requests without a key always create. They take no part in the join, where they would
    all meet in one partition.
    """
    key = ["queue", "idempotency_key"]
    keyed = requests.where(F.col("idempotency_key").isNotNull())
    first = F.min_by("request_id", F.struct("requested_at", "request_id"))
    winners = keyed.groupBy(*key).agg(first.alias("task_request_id"))
    joined = keyed.join(winners, key, "left")
    free = requests.where(F.col("idempotency_key").isNull()).withColumn(
        "task_request_id", F.col("request_id")
    )
    return joined.unionByName(free).withColumn(
        "created", F.col("request_id") == F.col("task_request_id")
    )


def first_events(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The first payload per (queue, event_name); later ones are ignored."""
    at = F.struct("emitted_at", "seq")
    return (
        until(events, as_of, "emitted_at")
        .groupBy("queue", "event_name")
        .agg(
            F.min_by("payload", at).alias("payload"),
            F.min("emitted_at").alias("emitted_at"),
            F.count(F.lit(1)).alias("emitted"),
        )
    )


def attempt_budget(attempts: DataFrame) -> DataFrame:
    """Attempts used and left per task, against the latest limit."""
    limit = F.coalesce(
        F.max_by("max_attempts", F.struct(*ORDER)), F.lit(S.DEFAULT_MAX_ATTEMPTS)
    )
    used = attempts.groupBy(*TASK).agg(
        F.max("attempt").alias("used"), limit.alias("max_attempts")
    )
    left = F.greatest(F.col("max_attempts") - F.col("used"), F.lit(0))
    return used.withColumns({"left": left, "exhausted": left == 0})


def attempt_sequence(
    transitions: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Finished attempts in order, with the outcome before and the seconds since it."""
    ends = transitions.where(F.col("op").isin(*S.ATTEMPT_END_OPS)).select(
        *TASK, *ORDER, F.col("op").alias("outcome")
    )
    rows = windowed(
        ends,
        TASK,
        ORDER,
        sums={"number": F.lit(1)},
        lags={"previous_outcome": F.col("outcome"), "previous_ended_at": F.col("ts")},
        rows_per_segment=rows_per_segment,
    )
    gap = seconds_between(F.col("previous_ended_at"), F.col("ts"))
    return rows.withColumn("gap_s", gap).drop("previous_ended_at")


def due(state: Column, wake_at: Column, now: Column) -> Column:
    """Pending runs are due unless they wake later; sleeping ones once their wake time is past."""
    waiting = F.coalesce(wake_at <= now, state == "pending")
    return state.isin("pending", "sleeping") & waiting


def due_batch(runs: DataFrame, now: Column, k: int) -> DataFrame:
    """Up to ``k`` claimable runs per queue: no or the earliest wake time first, then id."""
    ready = runs.where(due(F.col("state"), F.col("wake_at"), now))
    return top_per_group(ready, ["queue"], ["wake_at", "run_id"], k, rank="place")


def latest_checkpoints(checkpoints: DataFrame, include_pending: bool = False) -> DataFrame:
    """The visible state per (task, checkpoint); presence is the row, a null state is a value."""
    visible = F.lit(True) if include_pending else F.col("status") == "committed"
    newest = F.max_by(
        F.struct("state", "status", "owner_run_id", "updated_at"),
        F.struct("updated_at", "owner_run_id"),
    )
    return (
        checkpoints.where(visible)
        .groupBy("task_id", "checkpoint_name")
        .agg(newest.alias("_row"))
        .select("task_id", "checkpoint_name", "_row.*")
    )


def replay(steps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Attach the committed value to each step; ``done`` says that one exists."""
    known = latest_checkpoints(checkpoints).select(
        "task_id", "checkpoint_name", F.col("state").alias("value"), F.lit(True).alias("_known")
    )
    joined = steps.join(known, ["task_id", "checkpoint_name"], "left")
    return joined.withColumn("done", F.coalesce("_known", F.lit(False))).drop("_known")


def remaining(steps: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Steps that still have to run."""
    committed = checkpoints.where(F.col("status") == "committed")
    return steps.join(
        committed.select("task_id", "checkpoint_name"),
        ["task_id", "checkpoint_name"],
        "left_anti",
    )


def cancel_overdue(snapshot: DataFrame, now: Column) -> DataFrame:
    """Live tasks past the deadline of their cancellation policy, cancelled at it.

    Needs spawned_at, max_delay_s and max_duration_s; a null limit never cancels.
    """
    deadline = cancellation_deadline(
        F.col("spawned_at"), F.col("started_at"), F.col("max_delay_s"), F.col("max_duration_s")
    )
    over = F.coalesce(~is_terminal(F.col("state")) & (deadline <= now), F.lit(False))
    return snapshot.withColumns(
        {
            "ended_at": F.when(over, deadline).otherwise(F.col("ended_at")),
            "state": F.when(over, "cancelled").otherwise(F.col("state")),
        }
    )


def apply_cancels(snapshot: DataFrame, cancels: DataFrame) -> DataFrame:
    """A task whose first cancel precedes its end is cancelled at that time."""
    first = cancels.groupBy(*TASK).agg(F.min("cancelled_at").alias("cancelled_at"))
    joined = snapshot.join(first, TASK, "left")
    wins = F.col("cancelled_at").isNotNull() & (
        ~is_terminal(F.col("state")) | (F.col("cancelled_at") < F.col("ended_at"))
    )
    wins = F.coalesce(wins, F.lit(False))
    return joined.withColumns(
        {
            "ended_at": F.when(wins, F.col("cancelled_at")).otherwise(F.col("ended_at")),
            "state": F.when(wins, "cancelled").otherwise(F.col("state")),
        }
    ).drop("cancelled_at")
