"""The mergeable fold: parts put together give the fold of the whole history."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.operators import history
from tallyfold.operators.fold import accumulate, fold_state, merge, show
from tallyfold.queries.views import view

SF_DIR = "/root/testdata/sf0.01"
START = datetime(2024, 1, 1)
SCHEMA = (
    "queue string, task_id string, run_id string, attempt int, max_attempts int, task_name string, "
    "op string, ts timestamp_ntz, seq long, payload string, wake_at timestamp_ntz, lease_s long, "
    "event_name string"
)
OPS = (
    "spawn", "retry", "claim", "claim", "claim", "schedule", "await_event", "wake", "heartbeat",
    "checkpoint", "fail", "complete", "cancel",
)


def history_rows(seed, tasks=60, most=14):
    rng = random.Random(seed)
    rows, seq = [], 0
    for task in range(tasks):
        at = START
        for _ in range(rng.randint(1, most)):
            at += timedelta(minutes=rng.randint(0, 5))
            seq += 1
            op = rng.choice(OPS)
            rows.append(
                ("q", f"t{task}", f"r{seq}", rng.randint(1, 3), 3, "n", op, at, seq, f"p{seq}",
                 at + timedelta(minutes=3) if rng.random() < 0.5 else None,
                 60 if op in ("claim", *S.LEASE_OPS) and rng.random() < 0.5 else None, "e" if op == "await_event" else None)
            )
    return rows


def model(rows):
    """The state of one task, row by row."""
    state = None
    for r in sorted(rows, key=lambda r: (r[7], r[8])):
        attempt, limit, op, ts, payload = r[3], r[4], r[6], r[7], r[9]
        if op in ("spawn", "retry"):
            state = dict(state="pending", result=None, event=None, lease=None, run=r[2])
            continue
        if state is None or state["state"] in S.TERMINAL_STATES:
            continue
        running = state["state"] == "running"
        if op in S.RELEASE_OPS and not running:
            continue
        if op in S.LEASE_OPS:
            if running and r[11]:
                state["lease"] = ts + timedelta(seconds=r[11])
            continue
        if op == "wake":
            if state.get("awaits"):
                state.update(state="pending", event=payload, awaits=False)
            continue
        state["run"], state["awaits"] = r[2], op == "await_event"
        if op == "claim":
            state.update(state="running", event=payload)
            state["lease"] = ts + timedelta(seconds=r[11]) if r[11] else None
        elif op == "complete":
            state.update(state="completed", result=payload)
        elif op == "cancel":
            state.update(state="cancelled")
        elif op == "fail":
            later = r[10] is not None and r[10] > ts
            state.update(state="failed" if attempt >= limit else "sleeping" if later else "pending")
        else:
            state.update(state="sleeping")
    return state


def collected(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_a_row_by_row_model(spark, seed):
    rows = history_rows(seed)
    table = spark.createDataFrame(rows, SCHEMA)
    found = {r.task_id: r for r in fold_state(table, details=True).collect()}
    segmented = fold_state(table, details=True, rows_per_segment=16)
    assert collected(segmented) == sorted(map(str, found.values()))
    for task in {r[1] for r in rows}:
        state = model([r for r in rows if r[1] == task])
        if state is None:
            assert task not in found
            continue
        r = found[task]
        assert (r.state, r.result, r.run_id) == (state["state"], state["result"], state["run"])
        if r.state == "running":
            assert r.lease_until == state["lease"] and r.event_payload == state["event"]


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("details", [False, True])
def test_merging_parts_of_any_cut(spark, seed, details):
    rng = random.Random(seed)
    rows = history_rows(seed)
    # Every task has its own cuts; the parts of a task are in order.
    cuts = {r[1]: sorted(rng.randint(0, 14) for _ in range(3)) for r in rows}
    place, parts = {}, [[] for _ in range(4)]
    for r in rows:
        n = place[r[1]] = place.get(r[1], -1) + 1
        parts[sum(n >= c for c in cuts[r[1]])].append(r)
    tables = [spark.createDataFrame(p, SCHEMA) for p in parts]
    whole = collected(fold_state(spark.createDataFrame(rows, SCHEMA), details=details))
    sums = [accumulate(t, details) for t in tables]
    left = merge(merge(merge(sums[0], sums[1]), sums[2]), sums[3])
    right = merge(sums[0], merge(sums[1], merge(sums[2], sums[3])))
    assert collected(show(left, details)) == whole
    assert collected(show(right, details)) == whole


def test_merged_months_equal_the_whole_table(spark):
    rows = view(spark, SF_DIR, "transitions")
    days = [F.lit(f"2024-01-{d:02}").cast("timestamp_ntz") for d in (6, 13, 20)]
    parts = [rows.where(F.col("ts") < days[0])]
    parts += [rows.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(days, days[1:])]
    parts.append(rows.where(F.col("ts") >= days[-1]))
    merged = show(merge(*map(accumulate, parts)))
    assert collected(merged) == collected(fold_state(rows))


def test_fold_and_rejected_writes_share_one_rule(spark):
    """A sleeping task cannot be completed: the fold ignores the row and the report lists it."""
    made = [("spawn", 0), ("claim", 1), ("schedule", 2), ("complete", 3), ("claim", 4), ("fail", 5), ("cancel", 6)]
    rows = [("q", "t", "r", 3, 3, "n", op, START + timedelta(hours=h), h, None, None, None, None) for op, h in made]
    table = spark.createDataFrame(rows, SCHEMA)
    assert fold_state(table).first().state == "failed"
    assert fold_state(table.where("seq < 4")).first().state == "sleeping"
    found = {r.seq: (r.reason, r.ended_by, r.code) for r in history.rejected_writes(table).collect()}
    assert found == {3: ("not_running", None, None), 6: ("fail", "fail", "AB002")}


def test_a_lease_counts_from_its_claim(spark):
    made = [("spawn", 0, None), ("claim", 1, 60), ("schedule", 2, None), ("claim", 3, None)]
    rows = [("q", "t", "r", 1, 3, "n", op, START + timedelta(hours=h), h, None, None, s, None) for op, h, s in made]
    assert fold_state(spark.createDataFrame(rows, SCHEMA)).first().lease_until is None
