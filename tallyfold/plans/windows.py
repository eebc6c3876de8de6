"""Ordered windows that no single group can overload.

A plain window sorts each group in one task, which breaks when one task, queue or user
holds a third of the table. Here a group longer than ``rows_per_segment`` is cut into
ordered segments; every segment is a window group of its own, and a small table with one
row per segment carries running totals and edge values from one segment to the next.
Tables without such a group keep the plain window plan. Where the whole table is one group,
Spark's range partitioning cuts the segments, and the rest is the same.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import written

ROWS_PER_SEGMENT = 4_000_000
MARKS_PER_SEGMENT = 16
SEGMENTS_PER_BLOCK = 256


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    equal = [left[name].eqNullSafe(right[name]) for name in names]
    return reduce(Column.__and__, equal, F.lit(True))


def segment_bounds(
    df: DataFrame, keys: list[str], order: list[str], rows_per_segment: int
) -> DataFrame:
    """Half-open ranges ``[low, high)`` of ``order``, one row per segment of each long group.

    The cut points come from a hash sample, so a rerun of any task finds the same ones.
    """
    modulus = max(rows_per_segment // MARKS_PER_SEGMENT, 1)
    marks = df.select(*keys, F.struct(*order).alias("_at")).where(
        F.pmod(F.xxhash64(*keys, *order), F.lit(modulus)) == 0
    )
    by_position = Window.partitionBy(*keys).orderBy("_at")
    cuts = (
        marks.withColumn("_rank", F.row_number().over(by_position))
        .where(F.col("_rank") % MARKS_PER_SEGMENT == 0)
        .groupBy(*keys, "_at")
        .agg(F.max("_rank").alias("_rank"))
    )
    edges = Window.partitionBy(*keys).orderBy("_at")
    return cuts.select(
        *keys,
        F.row_number().over(edges).alias("_segment"),
        F.col("_at").alias("_low"),
        F.lead("_at").over(edges).alias("_high"),
    )


def _assign_segments(
    df: DataFrame, bounds: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Add ``_segment``: 0 before the first cut and for groups without cuts.

    Two lookups, first the block of segments and then the segment, keep the candidates
    per row near the square root of the number of cuts.
    """
    at = F.struct(*order)
    block = F.floor(F.col("_segment") / SEGMENTS_PER_BLOCK)
    fine = bounds.withColumn("_block", block)
    coarse = fine.groupBy(*keys, "_block").agg(
        F.min("_low").alias("_from"), F.max_by("_high", "_segment").alias("_to")
    )
    coarse = written(coarse, "segment-blocks")
    placed = df.withColumn("_at", at)
    hit = (
        _same(placed, coarse, keys)
        & (placed["_at"] >= coarse["_from"])
        & (coarse["_to"].isNull() | (placed["_at"] < coarse["_to"]))
    )
    placed = placed.join(coarse, hit, "left").select(placed["*"], coarse["_block"])
    hit = (
        _same(placed, fine, keys)
        & (placed["_block"] == fine["_block"])
        & (placed["_at"] >= fine["_low"])
        & (fine["_high"].isNull() | (placed["_at"] < fine["_high"]))
    )
    segment = F.coalesce(fine["_segment"], F.lit(0)).alias("_segment")
    return placed.join(fine, hit, "left").select(*[placed[c] for c in df.columns], segment)


def _range_segments(df: DataFrame, order: list[str], rows_per_segment: int) -> DataFrame:
    """``df`` as one group whose segments are the partitions of a range exchange.

    The input is written once, so that its row count and the exchange's own sample do not
    compute it again; the numbered rows are written since another run may cut elsewhere.
    """
    held = written(df, "ranged-input")
    parts = max(ceil(held.count() / rows_per_segment), 1)
    cut = held.repartitionByRange(parts, *order)
    return written(cut.withColumn("_segment", F.spark_partition_id()), "range-segments")


def windowed(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    sums: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    leads: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add running sums (current row included) and previous / next values per group.

    ``lasts`` are the last values before the row that are not null.

    ``order`` must identify a row within its group; ascending. An empty ``keys`` treats
    the whole table as one group, with the same plan at any size.
    """
    sums, lags, leads, lasts = sums or {}, lags or {}, leads or {}, lasts or {}
    if keys:
        bounds = written(segment_bounds(df, keys, order, rows_per_segment), "segment-bounds")
        if bounds.isEmpty():
            return _local(df, Window.partitionBy(*keys).orderBy(*order), sums, lags, leads, lasts)
        cut = _assign_segments(df, bounds, keys, order)
    else:
        cut = _range_segments(df, order, rows_per_segment)
    groups = [*keys, "_segment"]
    within = Window.partitionBy(*groups).orderBy(*order)
    rows = _local(cut, within, sums, lags, leads, lasts)
    rows = rows.withColumn("_first", F.row_number().over(within) == 1)
    rows = rows.withColumn("_last", F.lead(F.lit(1)).over(within).isNull())

    at = F.struct(*order)
    totals = cut.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(e).alias(f"_sum_{n}") for n, e in sums.items()],
        *[F.max_by(e, at).alias(f"_end_{n}") for n, e in lags.items()],
        *[F.min_by(e, at).alias(f"_start_{n}") for n, e in leads.items()],
        *[F.max_by(e, F.when(e.isNotNull(), at)).alias(f"_last_{n}") for n, e in lasts.items()],
    )
    if keys:
        # Only groups with cuts need a carry, so the carry has about one row per segment.
        long_groups = bounds.select(*keys).distinct()
        totals = totals.join(long_groups, _same(totals, long_groups, keys), "left_semi")
    chain = Window.partitionBy(*keys).orderBy("_segment")
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *groups,
        *[F.sum(f"_sum_{n}").over(before).alias(f"_sum_{n}") for n in sums],
        *[F.lag(f"_end_{n}").over(chain).alias(f"_end_{n}") for n in lags],
        *[F.lead(f"_start_{n}").over(chain).alias(f"_start_{n}") for n in leads],
        *[F.last(f"_last_{n}", True).over(before).alias(f"_last_{n}") for n in lasts],
    )
    carry = written(carry, "segment-carry")
    joined = rows.join(carry, _same(rows, carry, groups), "left")
    return joined.select(
        *[rows[c] for c in df.columns],
        *[(rows[n] + F.coalesce(carry[f"_sum_{n}"], F.lit(0))).alias(n) for n in sums],
        *[F.when(rows["_first"], carry[f"_end_{n}"]).otherwise(rows[n]).alias(n) for n in lags],
        *[F.when(rows["_last"], carry[f"_start_{n}"]).otherwise(rows[n]).alias(n) for n in leads],
        *[F.coalesce(rows[n], carry[f"_last_{n}"]).alias(n) for n in lasts],
    )


def _local(df, window, sums, lags, leads, lasts) -> DataFrame:
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        *[F.sum(e).over(running).alias(n) for n, e in sums.items()],
        *[F.lag(e).over(window).alias(n) for n, e in lags.items()],
        *[F.lead(e).over(window).alias(n) for n, e in leads.items()],
        *[F.last(e, True).over(earlier).alias(n) for n, e in lasts.items()],
    )
