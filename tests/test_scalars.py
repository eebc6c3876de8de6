"""Literal cases of names, text bounds, JSON, times and error classes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import payload, text, timing
from tallyfold.operators import audits, catalog


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "name, problem",
    [("   ", None), ("é" * 28 + "a", None), ("é" * 29, "too_long"), ("", "empty"), (None, "empty")],
)
def test_queue_names(spark, name, problem):
    assert one(spark, text.queue_problem(F.lit(name).cast("string"))) == problem


@pytest.mark.parametrize(
    "name, problem", [("step", None), (" \t\n", "empty"), (" ", "empty"), (None, "empty")]
)
def test_durable_names(spark, name, problem):
    assert one(spark, text.durable_problem(F.lit(name).cast("string"))) == problem


def test_invalid_bytes(spark):
    bad = F.lit(bytes([255, 254])).cast("string")
    assert one(spark, text.queue_problem(bad)) == "invalid_utf8"
    assert one(spark, text.durable_problem(bad)) == "invalid_utf8"
    assert one(spark, text.bounded_text(bad, 32)) == "<<255, 254>>"


@pytest.mark.parametrize("value", ["é" * 5000, "a" + "é" * 5000, "日本" * 40, "😀" * 33, "ok", ""])
@pytest.mark.parametrize("size", [3, 7, 32, 4096])
def test_bounded_text(spark, value, size):
    found = one(spark, text.bounded_text(F.lit(value), size))
    raw = value.encode()
    if len(raw) <= size:
        assert found == value
    else:
        assert found == raw[: size - 3].decode(errors="ignore") + "..."
        assert len(found.encode()) <= size


def test_failure_record(spark):
    trace = "\n".join(f"frame {i} " + "x" * 500 for i in range(30))
    record = text.failure_record(F.lit("E" * 200), F.lit("é" * 5000), F.lit(trace))
    row = one(spark, record)
    assert len(row.name.encode()) <= 128 and row.name.endswith("...")
    assert len(row.message.encode()) <= 4096 and row.message.endswith("...")
    assert len(row.stacktrace.encode()) <= 8192
    short = one(spark, text.failure_record(F.lit("E"), F.lit("m"), F.lit("a\n" * 30)))
    assert short.stacktrace.count("a") == 20
    assert one(spark, text.failure_record(F.lit("E"), F.lit("m"), F.lit(None).cast("string"))).stacktrace is None


def test_fnv_and_delay(spark):
    hex_id = "0123456789abcdef0123456789abcdef"
    uuid = "01234567-89ab-cdef-0123-456789abcdef"
    hashed = 2166136261
    for byte in uuid.encode():
        hashed = ((hashed ^ byte) * 16777619) & 0xFFFFFFFF
    assert one(spark, text.canonical_uuid(F.lit(hex_id))) == uuid
    assert one(spark, text.fnv1a_uuid(F.lit(uuid))) == hashed
    assert one(spark, text.unknown_task_delay(F.lit(hex_id))) == 15 + hashed % 16


@pytest.mark.parametrize(
    "value, ok",
    [('{"a":[null,true,1.5]}', True), ("null", True), ('"x"', True), ("{bad", False),
     ("", False), (None, True)],
)
def test_json(spark, value, ok):
    assert one(spark, payload.is_json(F.lit(value).cast("string"))) is ok


@pytest.mark.parametrize("ms, seconds", [(0, 0), (1, 1), (1000, 1), (1500, 2), (90000, 90)])
def test_whole_seconds(spark, ms, seconds):
    assert one(spark, timing.whole_seconds(F.lit(ms))) == seconds


@pytest.mark.parametrize(
    "kind, base, factor, maximum, attempt, delay",
    [
        ("none", 9.0, 2.0, None, 3, 0.0), ("fixed", 9.0, 2.0, None, 3, 9.0),
        ("exponential", 2.0, 3.0, None, 3, 18.0), ("exponential", 2.0, None, None, 4, 16.0),
        ("exponential", 2.0, 3.0, 10.0, 3, 10.0), (None, 2.0, 3.0, 10.0, 3, 0.0),
    ],
)
def test_retry_delay(spark, kind, base, factor, maximum, attempt, delay):
    values = [F.lit(kind).cast("string"), *[F.lit(v).cast("double") for v in (base, factor, maximum)]]
    assert one(spark, timing.retry_delay(*values, F.lit(attempt))) == delay


def test_wake_times(spark):
    wake = F.lit(datetime(2026, 1, 2, 3, 4, 5, 600)).cast("timestamp")
    encoded = timing.encode_wake_at(wake)
    assert one(spark, encoded) == "2026-01-02T03:04:05.000600Z"
    assert one(spark, timing.decode_wake_at(encoded) == wake)
    for bad in ("soon", "2026-01-02T03:04:05", "2026-01-02", ""):
        assert one(spark, timing.decode_wake_at(F.lit(bad))) is None
    assert one(spark, timing.remaining_milliseconds(wake, wake + F.expr("interval 1 day"))) == 0


@pytest.mark.parametrize(
    "value, ok", [("30 days", True), ("1 hour", True), ("  ", False), ("x", False), (None, True)]
)
def test_intervals(spark, value, ok):
    assert one(spark, timing.interval_is_valid(F.lit(value).cast("string"))) is ok


def test_snapshots_round_trip(spark):
    failure = F.struct(
        F.lit("E").alias("name"), F.lit('say "x"').alias("message"), F.lit(None).cast("string").alias("stacktrace")
    )
    for state in ("completed", "failed", "cancelled"):
        encoded = payload.encode_snapshot(F.lit(state), F.lit('{"a":[1]}'), failure)
        back = one(spark, payload.decode_snapshot(encoded))
        assert back.state == state
        assert back.result == ('{"a":[1]}' if state == "completed" else None)
        assert (back.failure.message if state == "failed" else back.failure) == (
            'say "x"' if state == "failed" else None
        )
    assert one(spark, payload.encode_snapshot(F.lit("running"), F.lit("1"), failure)) is None
    assert one(spark, payload.decode_snapshot(F.lit('{"state":"running"}'))) is None
    null = payload.encode_snapshot(F.lit("completed"), F.lit(None).cast("string"), failure)
    assert one(spark, payload.decode_snapshot(null)).result == "null"


def test_error_classes(spark):
    cases = [
        ("complete_run", "AB001", None, "cancelled"), ("complete_run", "AB002", None, "failed_run"),
        ("spawn_task", None, "closed", "ambiguous"), ("get_task_result", None, "closed", "database"),
        ("spawn_task", None, "queue_timeout", "database"), ("spawn_task", "23505", None, "database"),
    ]
    df = spark.createDataFrame(
        cases, "operation string, sqlstate string, connection_reason string, expected string"
    )
    assert all(r.error_kind == r.expected for r in audits.classify_errors(df).collect())


def test_option_rules(spark):
    df = spark.createDataFrame(
        [
            (0, "fixed", 1.0, 2.0, 3.0, '{"a":1}', "none", ["queue"]),
            (1, "linear", 86401.0, -1.0, float("nan"), "[1]", "all", ["que"]),
            (None, None, None, None, None, None, None, None),
        ],
        "max_attempts int, retry_kind string, retry_base_seconds double, retry_factor double, "
        "retry_max_seconds double, headers_json string, detach_mode string, option_names array<string>",
    )
    found = [r.problems for r in audits.audit_options(df).collect()]
    assert found[0] == ["max_attempts"]
    assert found[1] == [
        "retry_kind", "retry_base_seconds", "retry_factor", "retry_max_seconds", "headers_json",
        "detach_mode", "unknown_option",
    ]
    assert found[2] == []


def test_routes(spark):
    names = spark.createDataFrame(
        [("email", "mail"), ("free", None)], "task_name string, catalog_queue string"
    )
    asked = spark.createDataFrame(
        [
            ("1", "email", None, "mail", None), ("2", "email", "mail", "mail", None),
            ("3", "email", "x", None, "queue_mismatch"), ("4", "free", None, "main", None),
            ("5", "raw", "x", "x", None), ("6", "raw", None, None, "queue_required"),
        ],
        "request_id string, task_name string, queue string, to string, why string",
    )
    for row in catalog.route(asked, names, "main").collect():
        assert (row.routed_queue, row.reason) == (row.to, row.why)
