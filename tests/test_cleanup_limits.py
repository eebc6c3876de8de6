"""Cleanup under limits that differ by queue, some too large for the salted cut."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators.retention import cleanup_all
from tallyfold.plans import top_per_group
from tallyfold.plans.topk import SALTED_MOST

START = dt.datetime(2024, 1, 1)
LIMITS = {"small": 3, "none": 0, "large": SALTED_MOST + 1, "default": None}


def tasks(spark, rows=400):
    data = [
        (queue, f"t{i:04}", "completed" if i % 5 else "running", START + dt.timedelta(minutes=i % 90))
        for queue in [*LIMITS, "unlisted"]
        for i in range(rows)
    ]
    return spark.createDataFrame(
        data, "queue string, task_id string, state string, ended_at timestamp_ntz"
    )


def events(spark):
    data = [("large", f"e{i}", START + dt.timedelta(hours=i), i) for i in range(50)]
    return spark.createDataFrame(
        data, "queue string, event_name string, emitted_at timestamp_ntz, seq long"
    )


def policies(spark, *queues):
    data = [(q, "1 hour", LIMITS[q]) for q in queues]
    return spark.createDataFrame(data, "queue string, cleanup_ttl string, cleanup_limit int")


def cleaned(spark, *queues):
    now = F.lit(START + dt.timedelta(hours=2)).cast("timestamp_ntz")
    return cleanup_all(tasks(spark), events(spark), policies(spark, *queues), now)


def test_each_queue_has_its_own_limit(spark):
    gone, events_gone = cleaned(spark, *LIMITS)
    counts = {r["queue"]: r["count"] for r in gone.groupBy("queue").count().collect()}
    old = tasks(spark).where("state = 'completed' AND ended_at < TIMESTAMP_NTZ '2024-01-01 01:00:00'")
    eligible = old.groupBy("queue").count().where("queue = 'large'").first()["count"]
    assert counts == {"small": 3, "large": eligible, "default": eligible}
    first = old.where("queue = 'small'").orderBy("ended_at", "task_id").limit(3)
    ours = gone.where("queue = 'small'").orderBy("place")
    assert [r.task_id for r in ours.collect()] == [r.task_id for r in first.collect()]
    assert [r.place for r in ours.collect()] == [1, 2, 3]
    assert sorted(r.event_name for r in events_gone.collect()) == ["e0"]


@pytest.mark.parametrize("queues", [(), ("small",), ("large",)])
def test_few_policies(spark, queues):
    gone, _ = cleaned(spark, *queues)
    assert {r.queue for r in gone.select("queue").distinct().collect()} == set(queues)


@pytest.mark.parametrize("n", [5, SALTED_MOST + 1])
def test_own_limits_of_groups(spark, n):
    df = tasks(spark).withColumn("own", F.length("queue"))
    order = ["ended_at", "task_id"]
    ours = top_per_group(df, ["queue"], order, n, own="own")
    place = F.row_number().over(Window.partitionBy("queue").orderBy(*order)).cast("long")
    plain = df.withColumn("rank", place).where((F.col("rank") <= n) & (F.col("rank") <= F.col("own")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
