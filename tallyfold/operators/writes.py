"""Bulk writes: each request becomes a history row or is returned with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.payload import is_json
from tallyfold.functions.text import durable_problem, queue_problem
from tallyfold.functions.timing import after, after_milliseconds, retry_delay, whole_seconds
from tallyfold.operators.audits import option_problems
from tallyfold.operators.catalog import resolve_options, route
from tallyfold.operators.fold import SPEC, TASK, strategy_delay
from tallyfold.operators.history import dedupe_requests, due_batch, first_events, is_terminal
from tallyfold.session import written

REQUEST_ORDER = ["ts", "seq"]
#: What a request says about its task, besides ids; ``submit`` passes on those that are given.
SPAWN_COLUMNS = (
    "task_name", "params", "headers", "max_attempts", "requested_at", "retry_kind",
    "retry_base_seconds", "retry_factor", "retry_max_seconds", "max_delay_s", "max_duration_s",
)
RETRY_COLUMNS = ("retry_kind", "retry_base_seconds", "retry_factor", "retry_max_seconds")


def new_id(*parts: Column) -> Column:
    """32 hex digits from the given values, so a rerun makes the same ids."""
    texts = [F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]
    return F.md5(F.concat_ws("\1", *texts))


def _decided(snapshot: DataFrame, requests: DataFrame, needs_running: bool) -> DataFrame:
    """Requests with the current run and ``reason`` and ``code`` of a refusal."""
    current = snapshot.select(
        *TASK,
        F.col("run_id").alias("_run_id"),
        F.col("attempt").alias("_attempt"),
        F.col("max_attempts").alias("_max_attempts"),
        F.col("task_name").alias("_task_name"),
        F.col("state").alias("_state"),
        *(F.col(c).alias(f"_{c}") for c in ("retry_strategy",) if c in snapshot.columns),
    )
    joined = requests.join(current, TASK, "left")
    state = F.col("_state")
    reason = (
        F.when(state.isNull(), "unknown_task")
        .when(is_terminal(state), state)
        .when(F.lit(needs_running) & (state != "running"), "not_running")
    )
    code = F.when(state == "cancelled", S.CANCELLED_CODE).when(state == "failed", S.FAILED_CODE)
    return joined.withColumns({"reason": reason, "code": code})


def _record(
    snapshot: DataFrame,
    requests: DataFrame,
    op: str,
    *,
    once: bool,
    needs_running: bool = True,
    payload: Column | None = None,
    wake_at: Column | None = None,
    lease_s: Column | None = None,
    event_name: Column | None = None,
) -> DataFrame:
    """History rows for the legal requests and reasons for the others, in one table.

    With ``once`` only the first legal request per task is taken: it releases the run.
    """
    rows = _decided(snapshot, requests, needs_running)
    if "_refused" in requests.columns:
        rows = rows.withColumn("reason", F.coalesce("reason", "_refused"))
    if once:
        # Whether a request is legal depends on its task alone, so the first one of all is
        # the first legal one.
        first = requests.groupBy(*TASK).agg(F.min(F.struct(*REQUEST_ORDER)).alias("_first"))
        rows = rows.join(first, TASK, "left")
        late = F.col("reason").isNull() & (F.struct(*REQUEST_ORDER) != F.col("_first"))
        rows = rows.withColumn("reason", F.when(late, "superseded").otherwise(F.col("reason")))

    def field(value: Column | None, kind: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind)

    ts_type = requests.schema["ts"].dataType.simpleString()
    return rows.select(
        *TASK,
        F.col("_run_id").alias("run_id"),
        F.col("_attempt").alias("attempt"),
        F.col("_max_attempts").alias("max_attempts"),
        F.col("_task_name").alias("task_name"),
        F.lit(op).alias("op"),
        *REQUEST_ORDER,
        field(payload, "string").alias("payload"),
        field(wake_at, ts_type).alias("wake_at"),
        field(lease_s, "bigint").alias("lease_s"),
        field(event_name, "string").alias("event_name"),
        F.col("reason").isNull().alias("accepted"),
        "reason",
        "code",
    )


def claim(runs: DataFrame, now: Column, k: int, lease_ms: int) -> DataFrame:
    """Claim rows for up to ``k`` due runs per queue, with a lease in whole seconds.

    Of a snapshot with details the claim says why the run goes on: a run whose event arrived has
    its ``event_payload`` and no ``wake_event``, one that timed out the event's name and no payload.
    ``claim_history`` makes the claims rows of the history.
    """
    ready = due_batch(runs, now, k)
    dropped = ["state", "wake_at", "seq", "wake_event"]
    woken = []
    if "event_payload" in runs.columns:
        timed_out = F.when(F.col("state") == "sleeping", F.col("event_name"))
        woken = [timed_out.alias("wake_event")]
    return ready.select(
        *[c for c in runs.columns if c not in dropped],
        F.lit("claim").alias("op"),
        now.alias("ts"),
        F.col("place").alias("seq"),
        whole_seconds(F.lit(lease_ms)).alias("lease_s"),
        *woken,
    )


def claim_history(claims: DataFrame) -> DataFrame:
    """Rows of the history for claims of a snapshot with details."""
    return claims.select(
        *TASK, "run_id", "attempt", "max_attempts", "task_name", "op", "ts", "seq",
        F.col("event_payload").alias("payload"), F.lit(None).cast(claims.schema["ts"].dataType).alias("wake_at"),
        "lease_s", F.col("wake_event").alias("event_name"),
    )


def wake(snapshot: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """History rows for the sleeping tasks whose awaited event is there by ``now``.

    The first event of the name counts, also one from before the wait; one at the deadline or
    after it does not, and a wait without a deadline has no end. The task is then due, with the
    event's payload. ``snapshot`` has details, and tasks that are not waiting change nothing, so
    appending the rows and folding again ends after one round per wait.
    """
    first = first_events(events, now).select(
        "queue", "event_name", F.col("payload").alias("_payload"), F.col("emitted_at").alias("_at")
    )
    waits = snapshot.where((F.col("state") == "sleeping") & F.col("event_name").isNotNull())
    # Written, so that a hot name can be split between two plain shuffles.
    met = waits.join(written(first, "first-events"), ["queue", "event_name"]).where(
        F.col("wake_at").isNull() | (F.col("_at") < F.col("wake_at"))
    )
    return met.select(
        *TASK, "run_id", "attempt", "max_attempts", "task_name", F.lit(S.WAKE_OP).alias("op"),
        F.greatest("updated_at", "_at").alias("ts"), (F.col("seq") + 1).alias("seq"),
        F.col("_payload").alias("payload"),
        F.lit(None).cast(snapshot.schema["updated_at"].dataType).alias("wake_at"),
        F.lit(None).cast("long").alias("lease_s"), "event_name",
    )


def complete(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Complete running tasks with a JSON ``payload``."""
    return _record(snapshot, requests, "complete", once=True, payload=F.col("payload"))


def fail(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Fail running tasks; the next attempt wakes at ``retry_at`` or after the retry delay.

    A request may name a retry strategy; otherwise the one that the task was spawned with
    counts, which a snapshot with details has.
    """
    delay = F.lit(None).cast("double")
    if "retry_strategy" in snapshot.columns:
        delay = strategy_delay("_retry_strategy", F.col("_attempt"))
    if "retry_kind" in requests.columns:
        asked = retry_delay(*[F.col(c) for c in RETRY_COLUMNS], F.col("_attempt"))
        own = F.lit(True) if "retry_strategy" not in snapshot.columns else F.col("retry_kind").isNotNull()
        delay = F.when(own, asked).otherwise(delay)
    wake_at = after(F.col("ts"), F.coalesce(delay, F.lit(0.0)))
    if "retry_at" in requests.columns:
        wake_at = F.coalesce("retry_at", wake_at)
    last = F.col("_attempt") >= F.col("_max_attempts")
    return _record(
        snapshot,
        requests,
        "fail",
        once=True,
        payload=F.col("payload"),
        wake_at=F.when(~last, wake_at),
    )


def schedule(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Put running tasks to sleep until ``wake_at`` and release them."""
    return _record(snapshot, requests, "schedule", once=True, wake_at=F.col("wake_at"))


def schedule_after(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Put running tasks to sleep for ``delay_ms`` milliseconds, which are not rounded."""
    wake_at = after_milliseconds(F.col("ts"), F.col("delay_ms"))
    return _record(snapshot, requests, "schedule", once=True, wake_at=wake_at)


def await_event(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Suspend running tasks until an event or the timeout in milliseconds."""
    wake_at = after(F.col("ts"), whole_seconds(F.col("timeout_ms")))
    return _record(
        snapshot,
        requests,
        "await_event",
        once=True,
        wake_at=wake_at,
        event_name=F.col("event_name"),
    )


def extend_lease(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Extend leases by ``lease_ms``, in whole seconds rounded up."""
    lease_s = whole_seconds(F.col("lease_ms"))
    return _record(snapshot, requests, "heartbeat", once=False, lease_s=lease_s)


def write_checkpoints(
    snapshot: DataFrame, requests: DataFrame, checkpoints: DataFrame
) -> DataFrame:
    """Checkpoint rows that also extend the lease; a committed checkpoint is kept as it is.

    ``payload`` is the JSON state and may be null. Within the batch the first value per
    checkpoint is taken; the others come back as ``superseded``, and requests for a committed
    checkpoint as ``already_committed``.
    """
    step = ["task_id", "checkpoint_name"]
    done = checkpoints.where(F.col("status") == "committed").select(*step).distinct()
    marked = requests.join(done.withColumn("_done", F.lit(True)), step, "left")
    first = requests.groupBy(*step).agg(F.min(F.struct(*REQUEST_ORDER)).alias("_first_value"))
    late = F.struct(*REQUEST_ORDER) != F.col("_first_value")
    marked = marked.join(first, step, "left").withColumn(
        "_refused", F.when(F.col("_done"), "already_committed").when(late, "superseded")
    )
    return _record(
        snapshot,
        marked.drop("_done", "_first_value"),
        "checkpoint",
        once=False,
        payload=F.col("payload"),
        lease_s=whole_seconds(F.col("lease_ms")),
        event_name=F.col("checkpoint_name"),
    )


def cancel(snapshot: DataFrame, requests: DataFrame) -> DataFrame:
    """Cancel live tasks, running or not."""
    return _record(snapshot, requests, "cancel", once=True, needs_running=False)


def retry(
    snapshot: DataFrame,
    requests: DataFrame,
    max_attempts: int | None = None,
    spawn_new: bool = False,
) -> DataFrame:
    """Retry failed tasks in place with the next attempt, or as a new task from attempt 1.

    New ids are hashes of the old id and attempt, so running it twice adds no second task. The
    first request per task counts; later ones come back as ``superseded``. Of a snapshot with
    details a new task gets the parameters, as ``payload``, and the options of the old one.
    """
    spec = ["params", *SPEC] if spawn_new and "params" in snapshot.columns else []
    current = snapshot.select(*TASK, "attempt", "max_attempts", "task_name", "state", *spec)
    first = requests.groupBy(*TASK).agg(F.min(F.struct(*REQUEST_ORDER)).alias("_first"))
    asked = requests.select(*TASK, F.struct(*REQUEST_ORDER).alias("_at")).join(first, TASK)
    rows = asked.join(current, TASK, "left").withColumn("source_task_id", F.col("task_id"))
    reason = F.when(F.col("state").isNull(), "unknown_task").when(
        F.col("state") != "failed", F.concat(F.lit("not_failed:"), F.col("state"))
    )
    old_attempt = F.col("attempt")
    next_attempt = F.lit(1) if spawn_new else old_attempt + 1
    task_id = new_id(F.col("task_id"), old_attempt) if spawn_new else F.col("task_id")
    floor = F.col("max_attempts") if spawn_new else F.greatest("max_attempts", next_attempt)
    limit = floor if max_attempts is None else F.lit(max_attempts)
    # A limit that is already used up leaves nothing to retry.
    reason = F.coalesce(
        reason,
        F.when(limit < next_attempt, "no_attempts_left"),
        F.when(F.col("_at") != F.col("_first"), "superseded"),
    )
    return rows.select(
        "queue",
        "source_task_id",
        task_id.alias("task_id"),
        new_id(task_id, next_attempt).alias("run_id"),
        next_attempt.alias("attempt"),
        limit.alias("max_attempts"),
        "task_name",
        F.lit("spawn" if spawn_new else "retry").alias("op"),
        F.col("_at.ts").alias("ts"),
        F.col("_at.seq").alias("seq"),
        reason.isNull().alias("accepted"),
        reason.alias("reason"),
        F.lit(spawn_new).alias("created"),
        *(F.col(c).alias("payload" if c == "params" else c) for c in spec),
    )


def submit(
    existing: DataFrame,
    requests: DataFrame,
    hook=None,
    catalog: DataFrame | None = None,
    default_queue: str = "default",
) -> DataFrame:
    """Spawn idempotently: a known (queue, key) gives the task it had, ``created`` false.

    ``hook`` maps the requests to requests, for example to add headers; names, payloads
    and options are checked before and after it. ``existing`` holds queue,
    idempotency_key, task_id, run_id and attempt. The task's name, parameters, headers and
    limits come along; ``spawn_history`` makes them rows of the history. With ``catalog`` the
    requests are routed first, and options that they leave out come from the task's defaults.
    """
    if catalog is not None:
        requests = _with_defaults(requests, catalog, default_queue)
    checked = _with_problem(requests)
    if hook is not None:
        ok = hook(checked.where(F.col("problem").isNull()).drop("problem"))
        refused = checked.where(F.col("problem").isNotNull())
        checked = _with_problem(ok).unionByName(refused, allowMissingColumns=True)
    valid = dedupe_requests(checked.where(F.col("problem").isNull()))
    refused = checked.where(F.col("problem").isNotNull()).select(
        "request_id",
        "queue",
        "idempotency_key",
        F.lit(None).cast("string").alias("task_id"),
        F.lit(None).cast("string").alias("run_id"),
        F.lit(None).cast("int").alias("attempt"),
        F.lit(False).alias("created"),
        "problem",
        *(c for c in checked.columns if c in SPAWN_COLUMNS),
    )
    key = ["queue", "idempotency_key"]
    known = existing.where(F.col("idempotency_key").isNotNull()).select(
        *key,
        F.col("task_id").alias("_task_id"),
        F.col("run_id").alias("_run_id"),
        F.col("attempt").alias("_attempt"),
    )
    task_id = new_id(F.col("queue"), F.col("task_request_id"))
    keyed = valid.where(F.col("idempotency_key").isNotNull()).join(known, key, "left")
    free = valid.where(F.col("idempotency_key").isNull())
    spawned = keyed.unionByName(free, allowMissingColumns=True).select(
        "request_id",
        "queue",
        "idempotency_key",
        F.coalesce("_task_id", task_id).alias("task_id"),
        F.coalesce("_run_id", new_id(task_id, F.lit(1))).alias("run_id"),
        F.coalesce("_attempt", F.lit(1)).alias("attempt"),
        (F.col("created") & F.col("_task_id").isNull()).alias("created"),
        F.lit(None).cast("string").alias("problem"),
        *(c for c in checked.columns if c in SPAWN_COLUMNS),
    )
    return spawned.unionByName(refused)


def spawn_history(
    submitted: DataFrame, default_max_attempts: int = S.DEFAULT_MAX_ATTEMPTS
) -> DataFrame:
    """The history rows of the tasks that ``submit`` created, to append to ``transitions``.

    ``params`` becomes the payload; headers, retry strategy and cancellation limits are columns
    of their own (``schemas.HISTORY``). Rows of a task are numbered from 0, the spawn.
    """
    given = {c: F.col(c) if c in submitted.columns else F.lit(None) for c in SPAWN_COLUMNS}
    strategy = F.struct(
        *[given[c].cast(f.dataType).alias(f.name) for c, f in zip(RETRY_COLUMNS, S.RETRY_STRATEGY)]
    )
    return submitted.where("created").select(
        *TASK,
        "run_id",
        "attempt",
        F.coalesce(given["max_attempts"].cast("int"), F.lit(default_max_attempts)).alias(
            "max_attempts"
        ),
        given["task_name"].cast("string").alias("task_name"),
        F.lit("spawn").alias("op"),
        F.col("requested_at").alias("ts"),
        F.lit(0).cast("long").alias("seq"),
        given["params"].cast("string").alias("payload"),
        F.lit(None).cast(submitted.schema["requested_at"].dataType).alias("wake_at"),
        F.lit(None).cast("long").alias("lease_s"),
        F.lit(None).cast("string").alias("event_name"),
        given["headers"].cast(S.SPEC_TYPES["headers"]).alias("headers"),
        F.when(given["retry_kind"].isNotNull(), strategy).alias("retry_strategy"),
        given["max_delay_s"].cast("long").alias("max_delay_s"),
        given["max_duration_s"].cast("long").alias("max_duration_s"),
    )


def _with_defaults(requests: DataFrame, catalog: DataFrame, default_queue: str) -> DataFrame:
    """Requests with their queue and options, and ``_refused`` where no queue takes them."""
    wanted = {"max_attempts": "int", "max_delay_s": "long", "max_duration_s": "long"}
    absent = {c: F.lit(None).cast(kind) for c, kind in wanted.items() if c not in requests.columns}
    full = requests.withColumns(absent) if absent else requests
    routed = route(full, catalog, default_queue).select(
        *[c for c in full.columns if c != "queue"],
        F.coalesce("routed_queue", "queue").alias("queue"),
        F.col("reason").alias("_refused"),
    )
    resolved = resolve_options(routed, catalog, default_queue=default_queue)
    return resolved.withColumns({c: F.col(f"resolved_{c}") for c in wanted}).drop(
        *[f"resolved_{c}" for c in wanted]
    )


def _with_problem(requests: DataFrame) -> DataFrame:
    """The first broken rule of each request: its route, names, payload, then options."""
    rules = [F.col("_refused")] if "_refused" in requests.columns else []
    rules += [queue_problem(F.col("queue")), durable_problem(F.col("task_name"))]
    if "params" in requests.columns:
        rules.append(F.when(~is_json(F.col("params")), F.lit("invalid_json")))
    rules.append(F.get(option_problems(requests.columns), F.lit(0)))
    return requests.withColumn("problem", F.coalesce(*rules))


def emit(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Event rows to append, and those whose names are refused; first-wins applies on read."""
    problem = F.coalesce(
        queue_problem(F.col("queue")), durable_problem(F.col("event_name"))
    )
    checked = events.withColumn("problem", problem)
    fine = checked.where(F.col("problem").isNull()).drop("problem")
    return fine, checked.where(F.col("problem").isNotNull())
