"""Durations, deadlines, wake times and retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Longer delays count as this one, some 6,000 years, so that no wake time overflows.
LONGEST_S = 200_000_000_000


def seconds_interval(seconds: Column) -> Column:
    zero = F.lit(0)
    held = F.greatest(F.least(seconds, F.lit(LONGEST_S)), F.lit(-LONGEST_S))
    bounded = F.when(seconds.isNotNull(), held)
    return F.make_dt_interval(zero, zero, zero, bounded.cast("decimal(18,6)"))


def whole_seconds(milliseconds: Column) -> Column:
    """Milliseconds as whole seconds, rounded up so a lease never ends early."""
    return F.floor((milliseconds.cast("bigint") + 999) / 1000).cast("bigint")


def after(start: Column, seconds: Column) -> Column:
    return start + seconds_interval(seconds)


def after_milliseconds(start: Column, milliseconds: Column) -> Column:
    """``start`` plus milliseconds, kept as fractional seconds."""
    return start + seconds_interval(milliseconds.cast("decimal(18,3)") / 1000)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` as a double with microsecond steps."""
    micros = [F.unix_micros(c.cast("timestamp")) for c in (start, end)]
    return (micros[1] - micros[0]) / F.lit(1e6)


def retry_delay(
    kind: Column, base: Column, factor: Column, maximum: Column, attempt: Column
) -> Column:
    """Seconds before the attempt after ``attempt``; null factor is 2, null maximum no cap."""
    base = F.coalesce(base, F.lit(0.0))
    raised = base * F.pow(F.coalesce(factor, F.lit(2.0)), attempt - 1)
    raised = F.when(base == 0, F.lit(0.0)).otherwise(raised)  # not zero times infinity
    delay = F.when(kind == "fixed", base).when(kind == "exponential", raised).otherwise(F.lit(0.0))
    return F.when(maximum.isNull(), delay).otherwise(F.least(delay, maximum))


def warning_deadline(extended_at: Column, lease_s: Column) -> Column:
    return after(extended_at, lease_s)


def hard_deadline(extended_at: Column, lease_s: Column) -> Column:
    return after(extended_at, lease_s * 2)


def encode_wake_at(wake_at: Column) -> Column:
    """ISO 8601 text in UTC with microseconds."""
    return F.date_format(wake_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def decode_wake_at(text: Column) -> Column:
    """The instant in ISO 8601 text, or null when it is not one.

    An offset is required: without one the text does not name an instant.
    """
    offset = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"
    return F.when(text.rlike(offset), F.try_to_timestamp(text))


def remaining_milliseconds(wake_at: Column, now: Column) -> Column:
    """Whole milliseconds until ``wake_at``, never below zero."""
    micros = F.unix_micros(wake_at.cast("timestamp")) - F.unix_micros(now.cast("timestamp"))
    return F.greatest(F.floor(micros / 1000), F.lit(0)).cast("bigint")


def interval_is_valid(text: Column) -> Column:
    """Null stays valid, since an omitted field is not changed; a blank or bad one is not."""
    return text.isNull() | ((F.trim(text) != "") & text.try_cast("interval").isNotNull())


def cancellation_deadline(
    spawned_at: Column, started_at: Column, max_delay_s: Column, max_duration_s: Column
) -> Column:
    """Latest time before the policy cancels: waiting limits apply only until the start."""
    waiting = F.when(started_at.isNull(), after(spawned_at, max_delay_s))
    running = after(started_at, max_duration_s)
    return F.coalesce(waiting, running)
