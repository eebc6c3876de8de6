"""Step names against a call-by-call model of the rule."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.operators.steps import allocate_names


def model(names):
    counts, taken, out = {}, set(), []
    for name in names:
        number = counts.get(name, 0) + 1
        made = name if number == 1 else f"{name}#{number}"
        ok = made not in taken
        if ok:
            counts[name] = number
            taken.add(made)
        out.append((made, ok))
    return out


def allocate(spark, executions, rows_per_segment=4_000_000):
    rows = [
        (f"t{e}", i, name) for e, names in enumerate(executions) for i, name in enumerate(names)
    ]
    df = spark.createDataFrame(rows, "task_id string, seq long, name string")
    done = allocate_names(df, ["task_id"], ["seq"], rows_per_segment).collect()
    found = {(r.task_id, r.seq): (r.checkpoint_name, r.accepted) for r in done}
    return [[found[f"t{e}", i] for i in range(len(n))] for e, n in enumerate(executions)]


@pytest.mark.parametrize(
    "names, expected",
    [
        (
            ["charge", "charge", "charge#2", "charge"],
            [("charge", True), ("charge#2", True), ("charge#2", False), ("charge#3", True)],
        ),
        (["literal#2"], [("literal#2", True)]),
        (
            ["reverse#2", "reverse", "reverse"],
            [("reverse#2", True), ("reverse", True), ("reverse#2", False)],
        ),
    ],
)
def test_known_collisions(spark, names, expected):
    assert allocate(spark, [names]) == [expected]


NAMES = ["a", "a#2", "a#3", "a#2#2", "a#2#3", "a#2#2#2", "a#02", "a#1", "b", "#2", "#2#2"]


def test_many_random_executions(spark):
    rng = random.Random(3)
    executions = [
        [rng.choice(NAMES[: rng.randrange(2, len(NAMES) + 1)]) for _ in range(rng.randrange(1, 25))]
        for _ in range(400)
    ]
    expected = [model(names) for names in executions]
    assert allocate(spark, executions) == expected
    assert any(not ok for calls in expected for _, ok in calls)
    assert allocate(spark, executions[:60], rows_per_segment=16) == expected[:60]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(NAMES), min_size=1, max_size=12), min_size=1, max_size=20))
def test_random_executions(spark, executions):
    assert allocate(spark, executions) == [model(names) for names in executions]
