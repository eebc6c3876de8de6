"""Names, ids and byte-bounded text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import schemas as S

ELLIPSIS = "..."
FNV_OFFSET = 2_166_136_261
FNV_PRIME = 16_777_619
UUID_CHARS = 36
SHOWN_BYTES = 50


def hex_id(binary_id: Column) -> Column:
    """Lowercase hexadecimal form of a 16-byte id."""
    return F.lower(F.hex(binary_id))


def canonical_uuid(hex_text: Column) -> Column:
    """32 hex digits as ``8-4-4-4-12``."""
    text = F.lower(hex_text)
    starts_and_lengths = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(text, s, n) for s, n in starts_and_lengths])


def idempotency_key(hex_task_id: Column, checkpoint_name: Column) -> Column:
    """Key for an external system: task id and checkpoint name."""
    return F.concat(F.lower(hex_task_id), F.lit(":"), checkpoint_name)


def fnv1a_uuid(uuid_text: Column) -> Column:
    """32-bit FNV-1a of a 36-character UUID, as a long.

    The length is fixed, so the rounds are unrolled into plain arithmetic that stays
    inside generated code.
    """

    def step(hashed: Column, position: int) -> Column:
        byte = F.ascii(F.substring(uuid_text, position, 1)).cast("bigint")
        return (hashed.bitwiseXOR(byte) * FNV_PRIME).bitwiseAND(F.lit(0xFFFFFFFF))

    return reduce(step, range(1, UUID_CHARS + 1), F.lit(FNV_OFFSET).cast("bigint"))


def unknown_task_delay(hex_run_id: Column) -> Column:
    """Seconds until a run with an unregistered name is tried again: a base plus a hash slot."""
    slot = fnv1a_uuid(canonical_uuid(hex_run_id)) % S.UNKNOWN_TASK_SLOTS
    return F.lit(S.UNKNOWN_TASK_BASE_SECONDS) + slot


def _printed_bytes(value: Column) -> Column:
    """The first bytes of a string that is not UTF-8, as readable numbers."""
    raw = F.hex(value.cast("binary"))
    size = F.octet_length(value)
    shown = F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(SHOWN_BYTES))),
        lambda i: F.conv(F.substring(raw, i * 2 - 1, F.lit(2)), 16, 10),
    )
    more = F.when(size > SHOWN_BYTES, F.lit(", ...")).otherwise(F.lit(""))
    return F.concat(F.lit("<<"), F.array_join(shown, ", "), more, F.lit(">>"))


def _bounded(text: Column, maximum: int) -> Column:
    raw = text.cast("binary")
    room = maximum - len(ELLIPSIS)
    # A code point has at most four bytes, so one of these prefixes ends on a boundary.
    prefixes = [
        F.try_validate_utf8(F.substring(raw, 1, max(room - back, 0)).cast("string"))
        for back in range(4)
    ]
    cut = F.concat(F.coalesce(*prefixes, F.lit("")), F.lit(ELLIPSIS))
    return F.when(F.octet_length(text) <= maximum, text).otherwise(cut)


def bounded_text(value: Column, maximum: int) -> Column:
    """At most ``maximum`` bytes of valid UTF-8; longer text ends in ``...``."""
    printed = _bounded(_printed_bytes(value), maximum)
    return F.when(F.is_valid_utf8(value), _bounded(value, maximum)).when(
        value.isNotNull(), printed
    )


def failure_record(
    name: Column, message: Column, trace: Column, *, frame_separator: str = "\n"
) -> Column:
    """Bounded failure struct; the trace keeps its first 20 frames."""
    frames = F.slice(F.split(trace, frame_separator), 1, S.MAX_TRACE_FRAMES)
    return F.struct(
        bounded_text(name, S.MAX_FAILURE_NAME_BYTES).alias("name"),
        bounded_text(message, S.MAX_FAILURE_MESSAGE_BYTES).alias("message"),
        bounded_text(F.array_join(frames, frame_separator), S.MAX_FAILURE_TRACE_BYTES).alias(
            "stacktrace"
        ),
    )


def queue_problem(name: Column) -> Column:
    """Why a queue name is refused, or null; blanks are allowed."""
    return (
        F.when(name.isNull() | (F.octet_length(name) == 0), F.lit("empty"))
        .when(~F.is_valid_utf8(name), F.lit("invalid_utf8"))
        .when(F.octet_length(name) > S.MAX_QUEUE_BYTES, F.lit("too_long"))
    )


def durable_problem(name: Column) -> Column:
    """Why a task, step or event name is refused, or null; blanks are refused."""
    return (
        F.when(name.isNull(), F.lit("empty"))
        .when(~F.is_valid_utf8(name), F.lit("invalid_utf8"))
        .when(~name.rlike(r"[^\p{Z}\s\x{85}]"), F.lit("empty"))
    )


def event_step_name(step_name: Column, event_name: Column) -> Column:
    return F.coalesce(step_name, F.concat(F.lit("$awaitEvent:"), event_name))


def child_step_name(step_name: Column, hex_task_id: Column) -> Column:
    return F.coalesce(step_name, F.concat(F.lit("$awaitTaskResult:"), F.lower(hex_task_id)))
