"""The state of tasks as accumulators that can be merged.

``accumulate`` reduces a part of the history to one row per task; ``merge`` puts an earlier and a
later part together; ``show`` gives the snapshot. Merging is associative, so the batch fold, a
stored compacted history and a stream share these three functions and cannot disagree:
``show(merge(accumulate(a), accumulate(b)))`` is ``show(accumulate(a + b))`` wherever the rows of
each task in ``a`` come before those in ``b``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.timing import after, retry_delay
from tallyfold.plans import ROWS_PER_SEGMENT, windowed

TASK = ["queue", "task_id"]
ORDER = ["ts", "seq"]
#: What a spawn row may say about its task, besides ``payload``, its parameters.
SPEC = ("headers", "retry_strategy", "max_delay_s", "max_duration_s")
#: Columns that ``show`` adds with ``details``.
DETAILS = (
    "params", *SPEC, "spawned_at", "wake_event", "event_payload", "seq",
)
_PARTS = (
    "starts", "start", "first", "last_op", "last", "end", "lease", "woken", "extended_at",
    "started_at", "spec",
)


def ends_task(op: Column, attempt: Column, max_attempts: Column) -> Column:
    """A failure ends the task only at its last attempt."""
    limit = F.coalesce(max_attempts, F.lit(S.DEFAULT_MAX_ATTEMPTS))
    return op.isin("complete", "cancel") | ((op == "fail") & (attempt >= limit))


def _ends(row: str = "") -> Column:
    return ends_task(*[F.col(row + c) for c in ("op", "attempt", "max_attempts")])


def is_phase(op: Column) -> Column:
    """Rows that change the phase of a task; the others add to it (leases, arrived events)."""
    return ~op.isin(*S.LEASE_OPS, S.WAKE_OP)


def is_legal(op: Column, before: Column) -> Column:
    """Whether a row counts, given the phase row before it: only a running task can be released.

    A row that does not count leaves the task as it is, so a task is running exactly while the
    phase row before, counted or not, is a claim.
    """
    return ~op.isin(*S.RELEASE_OPS) | F.coalesce(before == "claim", F.lit(False))


def before_each(
    rows: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT, **windows
) -> DataFrame:
    """Add ``_before``, the op of the phase row before each row of a task."""
    return windowed(
        rows,
        TASK,
        ORDER,
        lasts={"_before": F.when(is_phase(F.col("op")), F.col("op"))},
        rows_per_segment=rows_per_segment,
        **windows,
    )


def accumulate(
    transitions: DataFrame, details: bool = False, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """One row per task of a part of the history, of a size that does not depend on its rows.

    Rows before the last start that the part holds have no effect. The first release of a part
    without a start before it stays open (``first``): whether it counts depends on the part
    before. Payloads travel only for rows that end a task and for wake-ups; with ``details`` also
    for spawns and claims.
    """
    position = F.struct(*ORDER)
    op = F.col("op")
    shown = _ends() | (op == S.WAKE_OP)
    if details:
        shown = shown | op.isin("spawn", "claim")
    spec = [c for c in SPEC if details and c in transitions.columns]
    rows = transitions.select(
        *TASK, *ORDER, "op", "run_id", "task_name", "attempt", "max_attempts", "wake_at",
        "lease_s", "event_name", F.when(shown, F.col("payload")).alias("payload"), *spec,
    )
    given = F.struct(
        F.col("payload").alias("params"),
        *[F.col(c) if c in spec else F.lit(None).cast(S.SPEC_TYPES[c]).alias(c) for c in SPEC],
        F.col("ts").alias("spawned_at"),
    )
    starts = (
        rows.where(op.isin(*S.GENERATION_OPS))
        .groupBy(*TASK)
        .agg(
            F.max(position).alias("start"),
            F.count(F.lit(1)).alias("starts"),
            *([F.max_by(given, F.when(op == "spawn", position)).alias("spec")] if details else []),
        )
    )
    facts = F.struct(
        "op", "ts", "seq", "run_id", "task_name", "attempt", "max_attempts", "payload",
        "wake_at", "event_name",
    )
    phase, releases = is_phase(op), op.isin(*S.RELEASE_OPS)
    counts = phase & is_legal(op, F.col("_before"))
    opens = phase & releases & F.col("_before").isNull()
    lease = F.struct("ts", "seq", after(F.col("ts"), F.col("lease_s")).alias("until"))

    def at(condition: Column) -> Column:
        return F.when(condition, position)

    placed = before_each(rows.drop(*spec), rows_per_segment).join(starts, TASK, "left")
    groups = [*TASK, "start", "starts", *(["spec"] if details else [])]
    if details:  # Maps cannot be grouping keys.
        placed, groups = placed.drop("spec"), groups[:-1]
    found = (
        placed.where(F.col("start").isNull() | (position >= F.col("start")))
        .groupBy(*groups)
        .agg(
            F.min_by(facts, at(opens)).alias("first"),
            F.max_by("op", at(phase)).alias("last_op"),
            F.max_by(facts, at(counts)).alias("last"),
            F.min_by(facts, at(counts & _ends())).alias("end"),
            F.max_by(lease, at(F.col("lease_s").isNotNull())).alias("lease"),
            F.max_by(F.struct("ts", "seq", "payload"), at(op == S.WAKE_OP)).alias("woken"),
            F.max(F.when(op.isin(*S.LEASE_OPS), F.col("ts"))).alias("extended_at"),
            F.min(F.when(op == "claim", F.col("ts"))).alias("started_at"),
        )
    )
    if details:
        found = found.join(starts.select(*TASK, "spec"), TASK, "left")
    parts = [c for c in _PARTS if details or c != "spec"]
    return found.withColumn("starts", F.coalesce("starts", F.lit(0))).select(*TASK, *parts)


def merge(*parts: DataFrame) -> DataFrame:
    """The accumulators of all parts together; of each task, earlier parts come first."""
    return reduce(_merge_two, parts)


def _merge_two(earlier: DataFrame, later: DataFrame) -> DataFrame:
    names = [c for c in earlier.columns if c not in TASK]
    a = earlier.select(*TASK, *[F.col(c).alias(f"a_{c}") for c in names])
    b = later.select(*TASK, *[F.col(c).alias(f"b_{c}") for c in names])
    both = a.join(b, TASK, "full")
    col = F.col
    started = col("b_start").isNotNull()
    after_claim = F.coalesce(col("a_last_op") == "claim", F.lit(False))
    opened = F.when(after_claim, col("b_first"))
    # The release that was open ends the task only if it counts.
    ending = F.when(after_claim & _ends("b_first."), col("b_first"))

    def newer(name: str) -> Column:
        return F.coalesce(f"b_{name}", f"a_{name}")

    none = F.lit(None)
    within = {
        "first": F.when(col("a_last_op").isNull(), col("b_first")).otherwise(col("a_first")),
        "last": F.coalesce(col("b_last"), opened, col("a_last")),
        "end": F.coalesce(col("a_end"), ending, col("b_end")),
        "lease": newer("lease"),
        "woken": newer("woken"),
        "extended_at": F.greatest("a_extended_at", "b_extended_at"),
        "started_at": F.least("a_started_at", "b_started_at"),
    }
    merged = {
        "starts": F.coalesce("a_starts", F.lit(0)) + F.coalesce("b_starts", F.lit(0)),
        "start": newer("start"),
        "last_op": newer("last_op"),
        "spec": newer("spec") if "spec" in names else none,
    }
    for name, value in within.items():
        merged[name] = F.when(started, col(f"b_{name}")).otherwise(value)
    return both.select(*TASK, *[merged[c].alias(c) for c in names])


def show(accumulators: DataFrame, details: bool = False) -> DataFrame:
    """The snapshot: one row per task that was spawned or retried.

    The first row that ends the last generation decides, else the last row that counts. A task
    whose awaited event arrived is pending, with the event's payload. With ``details`` the columns
    ``DETAILS`` follow.
    """
    folded = accumulators.where(F.col("start").isNotNull())
    folded = folded.withColumn("_row", F.coalesce("end", "last"))
    row = {c: F.col(f"_row.{c}") for c in (
        "op", "ts", "seq", "run_id", "task_name", "attempt", "max_attempts", "payload", "wake_at",
        "event_name",
    )}
    op, ended = row["op"], F.col("end").isNotNull()
    retries = (op == "fail") & ~ended
    at = F.struct(row["ts"].alias("ts"), row["seq"].alias("seq"))

    def follows(name: str) -> Column:
        later = F.struct(f"{name}.ts", f"{name}.seq") > at
        return F.coalesce(later, F.lit(False))

    woken = ~ended & (op == "await_event") & follows("woken")
    state = (
        F.when(op == "complete", "completed")
        .when(op == "cancel", "cancelled")
        .when((op == "fail") & ended, "failed")
        .when(retries & (row["wake_at"] > row["ts"]), "sleeping")
        .when(op == "claim", "running")
        .when(woken, "pending")
        .when(op.isin("schedule", "await_event"), "sleeping")
        .otherwise("pending")
    )
    sleeping, running = state == "sleeping", state == "running"
    # A lease counts from its claim on, not one that an earlier attempt left.
    leased = running & F.coalesce(F.struct("lease.ts", "lease.seq") >= at, F.lit(False))
    extra = []
    if details:
        extra = [
            *[F.col(f"spec.{c}").alias(c) for c in ("params", *SPEC, "spawned_at")],
            F.when(running, row["event_name"]).alias("wake_event"),
            F.when(running, row["payload"])
            .when(woken, F.col("woken.payload"))
            .alias("event_payload"),
            row["seq"].alias("seq"),
        ]
    return folded.select(
        *TASK,
        row["run_id"].alias("run_id"),
        row["task_name"].alias("task_name"),
        F.col("starts").alias("generation"),
        F.when(retries, row["attempt"] + 1).otherwise(row["attempt"]).alias("attempt"),
        F.coalesce(row["max_attempts"], F.lit(S.DEFAULT_MAX_ATTEMPTS)).alias("max_attempts"),
        state.alias("state"),
        F.when(op == "complete", row["payload"]).alias("result"),
        F.when((op == "fail") & ended, row["payload"]).alias("failure"),
        "started_at",
        F.when(ended, row["ts"]).alias("ended_at"),
        F.when(sleeping, row["wake_at"]).alias("wake_at"),
        F.when(sleeping, row["event_name"]).alias("event_name"),
        F.when(leased, F.col("lease.until")).alias("lease_until"),
        F.when(running, F.greatest(row["ts"], F.col("extended_at")))
        .when(woken, F.col("woken.ts"))
        .otherwise(row["ts"])
        .alias("updated_at"),
        *extra,
    )


def fold_state(
    transitions: DataFrame,
    as_of: Column | None = None,
    now: Column | None = None,
    details: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """One row per task: the first row that ends its last generation, else its last row.

    A spawn or retry starts a generation; rows before the first are ignored. A task that is not
    running cannot be completed, failed or put to sleep: such rows are ignored, as the write
    operators refuse them. Heartbeats and checkpoints extend a lease and change nothing else:
    the latest lease since the claim counts. With ``now`` a running attempt whose lease has run
    out counts as failed at the end of the lease. ``details`` adds the columns ``DETAILS``.
    """
    rows = transitions if as_of is None else transitions.where(F.col("ts") <= as_of)
    shown = show(accumulate(rows, details, rows_per_segment), details)
    return shown if now is None else expire_leases(shown, now)


def expire_leases(snapshot: DataFrame, now: Column) -> DataFrame:
    """Count a lease that ran out by ``now`` as a failure of that attempt.

    Where the snapshot has the retry strategy, the next attempt sleeps for its delay.
    """
    expired = (F.col("state") == "running") & (F.col("lease_until") <= now)
    last = F.col("attempt") >= F.col("max_attempts")
    changed = {
        "state": F.when(expired & last, "failed").when(expired, "pending").otherwise(F.col("state")),
        "attempt": F.when(expired & ~last, F.col("attempt") + 1).otherwise(F.col("attempt")),
        "ended_at": F.when(expired & last, F.col("lease_until")).otherwise(F.col("ended_at")),
        "updated_at": F.when(expired, F.col("lease_until")).otherwise(F.col("updated_at")),
        "lease_until": F.when(~expired, F.col("lease_until")),
    }
    if "retry_strategy" in snapshot.columns:
        wake_at = after(F.col("lease_until"), strategy_delay("retry_strategy", F.col("attempt")))
        sleeps = expired & ~last & (wake_at > F.col("lease_until"))
        changed["state"] = F.when(sleeps, "sleeping").otherwise(changed["state"])
        changed["wake_at"] = F.when(sleeps, wake_at).otherwise(F.col("wake_at"))
    return snapshot.withColumns(changed)


def strategy_delay(strategy: str, attempt: Column) -> Column:
    """Seconds to the attempt after ``attempt`` by a strategy column; none without one."""
    parts = ("kind", "base_seconds", "factor", "max_seconds")
    return retry_delay(*[F.col(f"{strategy}.{p}") for p in parts], attempt)
