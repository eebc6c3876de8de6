"""Event waits on streams: a stream-stream join, and exact first-wins with timeouts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.functions.timing import after

OPEN = S.struct(
    "wait_id string, queue string, event_name string, wait_ts timestamp, timeout_s long"
)
ARRIVED = S.struct(
    "queue string, event_name string, payload string, emitted_at timestamp, seq long, "
    "moment timestamp"
)


def joined_waits(
    waits: DataFrame,
    events: DataFrame,
    event_ttl: str = "1 day",
    late: str = "10 minutes",
    salts: int = 8,
    longest_timeout_s: int = 86_400,
) -> DataFrame:
    """Stream-stream join of waits with every event before their deadline.

    Events are kept for ``event_ttl`` before a wait. A wait with several events gives several
    rows. Waits of at most ``longest_timeout_s`` are an outer join, whose state ends with that
    bound: an unmatched one appears once the watermark passes. Longer waits, and those without
    a timeout, stay in state until an event comes and appear only then, so no match is cut off.
    Adaptive execution does not split stateful joins, so the waits of one name are spread over
    ``salts`` keys and every event goes to each of them.
    """
    w = waits.withWatermark("wait_ts", late).select(
        "*",
        after(F.col("wait_ts"), F.col("timeout_s")).alias("deadline"),
        F.pmod(F.xxhash64("wait_id"), F.lit(salts)).alias("_salt"),
    )
    e = events.withWatermark("emitted_at", late).select(
        F.col("queue").alias("_queue"),
        F.col("event_name").alias("_name"),
        F.explode(F.array([F.lit(i).cast("long") for i in range(salts)])).alias("_to"),
        "payload",
        "emitted_at",
    )
    ttl = F.expr(f"INTERVAL {event_ttl}")
    in_time = (
        (F.col("queue") == F.col("_queue"))
        & (F.col("event_name") == F.col("_name"))
        & (F.col("_salt") == F.col("_to"))
        & (F.col("emitted_at") >= F.col("wait_ts") - ttl)
        & F.coalesce(F.col("emitted_at") < F.col("deadline"), F.lit(True))
    )
    # Repeats the bound with a constant, which is what lets Spark drop old rows.
    bounded = F.col("emitted_at") <= F.col("wait_ts") + F.expr(
        f"INTERVAL {int(longest_timeout_s)} SECOND"
    )
    short = F.coalesce(F.col("timeout_s") <= longest_timeout_s, F.lit(False))
    ending = w.where(short).join(e, in_time & bounded, "left_outer")
    lasting = w.where(~short).join(e, in_time, "inner")
    return ending.unionByName(lasting).drop("_queue", "_name", "_salt", "_to")


def wait_input(waits: DataFrame, events: DataFrame) -> DataFrame:
    """Both streams as one; ``moment`` is the time of either."""
    w = waits.select(*OPEN.names, F.col("wait_ts").alias("moment"))
    e = events.select(
        "queue", "event_name", "payload", "emitted_at", "seq", F.col("emitted_at").alias("moment")
    )
    return w.unionByName(e, allowMissingColumns=True)


def _earliest(frames):
    """One pass over a partition: the earliest event of each name, and a row with the newest time."""
    kept, ticks = None, None
    for frame in frames:
        if frame.empty:
            continue
        ticks = pd.concat([ticks, frame]) if ticks is not None else frame
        ticks = ticks.nlargest(1, "moment")
        found = frame[frame["emitted_at"].notna()]
        found = found if kept is None else pd.concat([kept, found])
        kept = found.sort_values(["emitted_at", "seq"]).drop_duplicates(["queue", "event_name"])
    if kept is not None:
        yield kept
        # The newest row without its event, so the watermark moves as if all rows were there.
        yield ticks.assign(queue=None, event_name=None, payload=None, emitted_at=pd.NaT)


def settled_waits(
    waits: DataFrame, events: DataFrame, late: str = "10 minutes", salts: int = 8
) -> DataFrame:
    """Each wait once, resolved or timed out; a stream in append mode.

    The first event of a name to arrive is the event of that name, for good, and of those that
    arrive together the earliest: the names are the state that grows, one row each. A wait is settled when that event is there, also from before
    the wait, or else when the watermark reaches its deadline; the clock is the newest time of
    both streams less ``late``, within which rows may come in any order. Waits without a
    timeout stay open until their event comes. Spark keeps and checkpoints the state: a batch
    costs what it brings and what it settles. Waits of one name are spread over ``salts``.
    """
    both = wait_input(waits, events)
    far = F.lit("9999-01-01").cast("timestamp")
    deadline = F.coalesce(after(F.col("wait_ts"), F.col("timeout_s")), far)
    # Each side carries the other's times too, so both watermarks move with the newer stream.
    until = F.greatest(F.coalesce(deadline, "moment"), F.col("moment"))
    asked = both.select(
        *OPEN.names,
        F.when(F.col("wait_ts").isNotNull(), deadline).alias("deadline"),
        F.when(F.col("wait_ts").isNotNull(), until).otherwise(F.col("moment")).alias("_until"),
        F.pmod(F.xxhash64("wait_id"), F.lit(salts)).alias("_salt"),
    )
    asked = asked.withWatermark("_until", late).where(F.col("_until") >= F.col("deadline"))
    known = both.select(
        "queue", "event_name", "payload", "emitted_at", F.coalesce("seq", F.lit(0)).alias("seq"),
        "moment",
    )
    # Within a batch a plain pass per partition, twice, so that a hot name is reduced first.
    known = known.mapInPandas(_earliest, ARRIVED).repartition("queue", "event_name")
    known = known.mapInPandas(_earliest, ARRIVED).select(
        F.col("queue").alias("_queue"), F.col("event_name").alias("_name"), "payload",
        "emitted_at", "moment",
    )
    known = known.withWatermark("moment", late).where(F.col("moment") <= F.col("emitted_at"))
    first = known.dropDuplicates(["_queue", "_name"])
    first = first.withColumn(
        "_to", F.explode(F.array([F.lit(i).cast("long") for i in range(salts)]))
    )
    met = (
        (F.col("queue") == F.col("_queue"))
        & (F.col("event_name") == F.col("_name"))
        & (F.col("_salt") == F.col("_to"))
        & (F.col("moment") < F.col("_until"))
    )
    found = F.col("_name").isNotNull()
    return asked.join(first, met, "left_outer").select(
        *OPEN.names,
        F.when(found, "resolved").otherwise("timed_out").alias("status"),
        F.when(found, F.col("payload")).alias("payload"),
        F.when(found, F.greatest("wait_ts", "emitted_at"))
        .otherwise(F.col("deadline"))
        .alias("resolved_at"),
    )
