"""Audits that list or count rows breaking the input rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.payload import is_json
from tallyfold.functions.text import durable_problem, queue_problem
from tallyfold.functions.timing import interval_is_valid

# Option names that a request may carry.
SPAWN_OPTIONS = (
    "max_attempts",
    "retry_strategy",
    "headers",
    "cancellation",
    "idempotency_key",
    "queue",
)
RETRY_KINDS = ("none", "fixed", "exponential")


def audit_names(df: DataFrame, queue: str, names: list[str]) -> DataFrame:
    """The problem of the queue name and of each durable name, null where there is none."""
    return df.select(
        "*",
        queue_problem(F.col(queue)).alias(f"{queue}_problem"),
        *[durable_problem(F.col(n)).alias(f"{n}_problem") for n in names],
    )


def audit_json(df: DataFrame, column: str, by: str) -> DataFrame:
    """Rows, null payloads and invalid payloads per group."""
    payload = F.col(column)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(payload.isNull()).alias("null_payloads"),
        F.count_if(~is_json(payload)).alias("invalid_payloads"),
    )


def _outside(value: Column, low: float, high: float | None = None) -> Column:
    finite = ~F.isnan(value.cast("double")) & (F.abs(value.cast("double")) < float("inf"))
    inside = finite & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return value.isNotNull() & ~inside


def option_problems(columns: list[str]) -> Column:
    """Names of the broken option rules of a row, as an array; absent columns are skipped."""
    col = F.col
    rules = {
        "max_attempts": lambda c: c.isNotNull() & (c <= 0),
        "retry_kind": lambda c: c.isNotNull() & ~c.isin(*RETRY_KINDS),
        "retry_base_seconds": lambda c: _outside(c, 0, S.MAX_RETRY_SECONDS),
        "retry_factor": lambda c: _outside(c, 0),
        "retry_max_seconds": lambda c: _outside(c, 0, S.MAX_RETRY_SECONDS),
        "max_delay_s": lambda c: c.isNotNull() & (c < 0),
        "max_duration_s": lambda c: c.isNotNull() & (c < 0),
        "headers_json": lambda c: ~(
            c.isNull() | F.coalesce(c.rlike(r"^\s*\{") & is_json(c), F.lit(False))
        ),
        "cleanup_ttl": lambda c: ~interval_is_valid(c),
        "partition_lookahead": lambda c: ~interval_is_valid(c),
        "partition_lookback": lambda c: ~interval_is_valid(c),
        "detach_min_age": lambda c: ~interval_is_valid(c),
        "cleanup_limit": lambda c: c.isNotNull() & (c <= 0),
        "detach_mode": lambda c: c.isNotNull() & ~c.isin("none", "empty"),
    }
    found = [
        F.when(rules[name](col(name)), F.lit(name)) for name in rules if name in columns
    ]
    if "option_names" in columns:
        known = F.array(*[F.lit(n) for n in SPAWN_OPTIONS])
        unknown = F.size(F.array_except(col("option_names"), known)) > 0
        found.append(F.when(unknown, F.lit("unknown_option")))
    return F.filter(F.array(*found), lambda name: name.isNotNull())


def audit_options(df: DataFrame) -> DataFrame:
    """Add ``problems``, the broken option rules of each row."""
    return df.withColumn("problems", option_problems(df.columns))


def contract_violations(
    df: DataFrame,
    *,
    ids: list[str] = (),
    counts: list[str] = (),
    positives: list[str] = (),
    enums: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """One row with the number of violations per rule; the batch is accepted only without any.

    Ids must be 16 bytes, here 32 lowercase hex digits.
    """
    checks = {
        **{f"{c}_not_id": ~F.col(c).rlike("^[0-9a-f]{32}$") for c in ids},
        **{f"{c}_negative": F.col(c) < 0 for c in counts},
        **{f"{c}_not_positive": F.col(c) <= 0 for c in positives},
        **{f"{c}_unknown": ~F.col(c).isin(*allowed) for c, allowed in (enums or {}).items()},
    }
    broken = {name: F.coalesce(check, F.lit(True)) for name, check in checks.items()}
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(check).alias(name) for name, check in broken.items()],
    )
    total = sum((F.col(name) for name in broken), F.lit(0))
    return counted.withColumn("accepted", total == 0)


def classify_errors(df: DataFrame) -> DataFrame:
    """Add ``error_kind``: the task's own codes first, then what a lost connection means.

    After a mutating operation was sent the outcome is unknown; when no connection could
    be checked out, nothing was sent.
    """
    lost = F.col("connection_reason").isNotNull() & (F.col("connection_reason") != "queue_timeout")
    kind = (
        F.when(F.col("sqlstate") == S.CANCELLED_CODE, "cancelled")
        .when(F.col("sqlstate") == S.FAILED_CODE, "failed_run")
        .when(lost & F.col("operation").isin(*S.MUTATING_OPERATIONS), "ambiguous")
        .otherwise("database")
    )
    return df.withColumn("error_kind", kind)
