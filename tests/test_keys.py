"""The bucketed key table: lookups, replays, merges, and plans that keep the stored side."""

import pytest

from tallyfold import schemas as S
from tallyfold.plans.ranges import covering
from tallyfold.session import new_path
from tallyfold.sources.keys import KeyTable

SCHEMA = S.struct("queue string, key string, task_id string")
KEYS = ["queue", "key"]


def table(spark, path=None, buckets=4):
    return KeyTable(spark, path or new_path(spark, "keys"), SCHEMA, KEYS, buckets)


def batch(spark, number, size=20):
    data = [(f"q{i % 3}", f"k{number}-{i}", f"t{number}-{i}") for i in range(size)]
    return spark.createDataFrame([*data, ("q0", None, "none"), (None, "k", "none")], SCHEMA)


def wanted(spark, *pairs):
    return spark.createDataFrame(list(pairs), "queue string, key string, other int")


def names(df):
    return sorted(r.task_id for r in df.collect())


def test_covering_ranges_hold_each_batch_once():
    for last in range(40):
        held = [b for first, end in covering(last) for b in range(first, end + 1)]
        assert held == list(range(last + 1))
        assert len(covering(last)) <= (last + 1).bit_length()


def test_find_over_many_batches(spark):
    keys = table(spark)
    for number in range(6):
        keys.append(batch(spark, number), number)
    asked = [("q0", "k0-0", 1), ("q0", "k0-0", 2), ("q1", "k5-1", 3), ("q2", "k5-1", 4)]
    asked += [("q0", None, 5), (None, "k", 6), ("q9", "new", 7)]
    assert names(keys.find(wanted(spark, *asked), 5)) == ["t0-0", "t5-1"]
    assert names(keys.find(wanted(spark, *asked), 4)) == ["t0-0"]
    assert keys.rows(5).count() == 120
    assert keys.find(wanted(spark, *asked), -1).count() == 0


def test_replayed_and_empty_batches(spark):
    keys = table(spark)
    keys.append(batch(spark, 0), 0)
    keys.append(batch(spark, 1, size=0), 1)
    keys.append(batch(spark, 2), 2)
    keys.append(batch(spark, 2), 2)
    assert keys.rows(2).count() == 40
    empty = table(spark)
    empty.append(batch(spark, 0, size=0), 0)
    assert empty.rows(0).count() == 0
    empty.append(batch(spark, 1), 1)
    assert empty.rows(1).count() == 20


def test_a_missing_batch_is_an_error(spark):
    keys = table(spark)
    keys.append(batch(spark, 0), 0)
    with pytest.raises(FileNotFoundError):
        keys.append(batch(spark, 2), 2)
    with pytest.raises(FileNotFoundError):
        keys.find(wanted(spark, ("q0", "k", 1)), 1)


def test_another_catalog_finds_what_is_stored(spark):
    keys = table(spark)
    keys.append(batch(spark, 0), 0)
    keys.append(batch(spark, 1), 1)
    spark.sql(f"DROP TABLE {keys.name}")
    again = table(spark, keys.path)
    assert again.rows(1).count() == 40
    again.append(batch(spark, 2), 2)
    assert again.rows(2).count() == 60


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_the_stored_side_is_not_shuffled(spark, threshold):
    keys = table(spark, buckets=4)
    for number in range(3):
        keys.append(batch(spark, number), number)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = keys.find(wanted(spark, ("q0", "k0-0", 1), ("q1", "k2-1", 1)), 2)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert names(found) == ["t0-0", "t2-1"]
        assert plan.count("Exchange") == 1  # the asked keys, dealt to buckets or broadcast
        if threshold == "-1":
            assert "SortMergeJoin" in plan and "Bucketed: true" in plan
            assert "hashpartitioning(queue" in plan and ", 4)" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
