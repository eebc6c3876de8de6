"""Fixed record shapes of the history tables and the rules that go with them."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "0.5.0"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


def struct(columns: str) -> T.StructType:
    """A flat schema from ``name type`` pairs; works before a session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def copy_of(schema: T.StructType) -> T.StructType:
    """A copy, since ``StructType.add`` changes the schema it is called on."""
    return T.StructType(list(schema.fields))


RETRY_STRATEGY = struct(
    "kind string, base_seconds double, factor double, max_seconds double"
)
SPEC_TYPES = {
    "headers": "map<string,string>",
    "retry_strategy": "struct<kind:string,base_seconds:double,factor:double,max_seconds:double>",
    "max_delay_s": "bigint",
    "max_duration_s": "bigint",
}
FAILURE = struct("name string, message string, stacktrace string")

REQUESTS = struct(
    "request_id string, queue string, task_name string, idempotency_key string, params string, "
    "headers map, max_attempts int, requested_at timestamp"
)
TASKS = struct(
    "queue string, task_id string, run_id string, attempt int, created boolean"
)
TRANSITIONS = struct(
    "queue string, task_id string, run_id string, attempt int, max_attempts int, "
    "task_name string, op string, ts timestamp, seq long, payload string, "
    "wake_at timestamp, lease_s long, event_name string"
)
#: Transitions with what a spawn row says about its task.
HISTORY = T.StructType(
    [
        *TRANSITIONS.fields,
        T.StructField("headers", _TYPES["map"]),
        T.StructField("retry_strategy", RETRY_STRATEGY),
        T.StructField("max_delay_s", T.LongType()),
        T.StructField("max_duration_s", T.LongType()),
    ]
)
CHECKPOINTS = struct(
    "task_id string, checkpoint_name string, state string, status string, "
    "owner_run_id string, updated_at timestamp"
)
EVENTS = struct(
    "queue string, event_name string, payload string, emitted_at timestamp, seq long"
)
WAITS = struct(
    "wait_id string, queue string, task_id string, run_id string, step_name string, "
    "event_name string, wait_ts timestamp, timeout_s long"
)
POLICIES = struct(
    "queue string, storage_mode string, partition_lookahead string, partition_lookback string, "
    "cleanup_ttl string, cleanup_limit int, detach_mode string, detach_min_age string"
)
SPANS = struct(
    "span_id string, component string, operation string, phase string, ts timestamp, "
    "outcome string, error_kind string"
)

TABLES = {
    "requests": REQUESTS,
    "tasks": TASKS,
    "transitions": TRANSITIONS,
    "history": HISTORY,
    "checkpoints": CHECKPOINTS,
    "events": EVENTS,
    "waits": WAITS,
    "policies": POLICIES,
    "spans": SPANS,
}

# Task states, the terminal ones, and what each transition leads to.
STATES = ("pending", "running", "sleeping", "completed", "failed", "cancelled")
TERMINAL_STATES = ("completed", "failed", "cancelled")
LEASE_OPS = ("heartbeat", "checkpoint")
GENERATION_OPS = ("spawn", "retry")
RELEASE_OPS = ("complete", "fail", "schedule", "await_event")
WAKE_OP = "wake"
ATTEMPT_END_OPS = ("complete", "fail", "cancel")

# Codes for writes that come after the task has ended.
CANCELLED_CODE = "AB001"
FAILED_CODE = "AB002"

# Operations whose outcome is unknown when the connection is lost.
MUTATING_OPERATIONS = (
    "create_queue",
    "set_queue_policy",
    "drop_queue",
    "spawn_task",
    "retry_task",
    "cancel_task",
    "emit_event",
    "claim_tasks",
    "complete_run",
    "schedule_run",
    "schedule_run_after",
    "fail_run",
    "set_task_checkpoint_state",
    "extend_claim",
    "await_event",
    "cleanup_all_queues",
    "cleanup_tasks",
    "cleanup_events",
)

# Size limits and defaults.
MAX_QUEUE_BYTES = 57
MAX_FAILURE_NAME_BYTES = 128
MAX_FAILURE_MESSAGE_BYTES = 4096
MAX_FAILURE_TRACE_BYTES = 8192
MAX_TRACE_FRAMES = 20
MAX_RETRY_SECONDS = 86_400
DEFAULT_MAX_ATTEMPTS = 5
DEFAULT_CLEANUP_LIMIT = 1000
UNKNOWN_TASK_BASE_SECONDS = 15
UNKNOWN_TASK_SLOTS = 16
