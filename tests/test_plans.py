"""Segmented windows and salted top-k equal the plain ones, hot groups included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.plans import top_per_group, windowed
from tallyfold.plans.windows import segment_bounds


def _skewed(spark, rows=3000, hot=0.4, ties=False):
    rng = random.Random(7)
    data = []
    for i in range(rows):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(40)}"
        ts = 5 if ties and key == "hot" else rng.randrange(400)
        data.append((None if key == "k0" else key, ts, i, rng.randrange(-5, 9)))
    return spark.createDataFrame(data, "key string, ts int, seq long, v long")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("size", [16, 64, 100_000])
def test_windowed_equals_plain_window(spark, keys, size, ties):
    df = _skewed(spark, ties=ties)
    order = ["ts", "seq"]
    ours = windowed(
        df,
        keys,
        order,
        sums={"n": F.lit(1), "total": F.col("v")},
        lags={"before": F.col("v")},
        leads={"after": F.col("ts")},
        rows_per_segment=size,
    )
    w = Window.partitionBy(*keys).orderBy(*order)
    plain = df.select(
        "*",
        F.count(F.lit(1)).over(w).alias("n"),
        F.sum("v").over(w).alias("total"),
        F.lag("v").over(w).alias("before"),
        F.lead("ts").over(w).alias("after"),
    )
    assert ours.columns == plain.columns
    assert _rows(ours) == _rows(plain)


@pytest.mark.parametrize("rows", [0, 1, 3000])
def test_one_group_has_one_plan_without_a_nested_loop(spark, rows):
    df = _skewed(spark, rows=rows, ties=True)
    ours = windowed(
        df, [], ["ts", "seq"], sums={"n": F.lit(1)}, lasts={"ok": F.col("v")}, rows_per_segment=50
    )
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "spark_partition_id" not in plan  # numbered once, in a written table
    order = Window.orderBy("ts", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    plain = df.select(
        "*",
        F.count(F.lit(1)).over(order).alias("n"),
        F.last("v", True).over(before).alias("ok"),
    )
    assert _rows(ours) == _rows(plain)


def test_long_groups_are_cut_and_short_ones_are_not(spark):
    df = _skewed(spark)
    bounds = segment_bounds(df, ["key"], ["ts", "seq"], 200)
    counts = {r["key"]: r["count"] for r in bounds.groupBy("key").count().collect()}
    assert counts["hot"] >= 3
    assert set(counts) == {"hot"}


def test_equal_order_values_stay_in_one_segment(spark):
    df = _skewed(spark).withColumn("seq", F.lit(0))
    ours = windowed(df, ["key"], ["ts", "seq"], sums={"n": F.lit(1)}, rows_per_segment=64)
    last = ours.groupBy("key").agg(F.max("n").alias("n"))
    assert _rows(last) == _rows(df.groupBy("key").agg(F.count("*").alias("n")))


@pytest.mark.parametrize("n", [1, 7, 200_000])
def test_top_per_group_equals_rank(spark, n):
    df = _skewed(spark)
    w = Window.partitionBy("key").orderBy("ts", "seq")
    plain = df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
    assert _rows(top_per_group(df, ["key"], ["ts", "seq"], n)) == _rows(plain)


def test_window_group_is_not_left_to_one_task(spark):
    df = _skewed(spark, rows=4000, hot=1.0)
    ours = windowed(df, ["key"], ["ts", "seq"], sums={"n": F.lit(1)}, rows_per_segment=100)
    parts = ours.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) > 1
