"""User functions: outcomes, retries, memoised steps, and resuming after a lost job."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.tasks import (
    ConfigurationError,
    Err,
    Ok,
    Registry,
    durable_step,
    run_tasks,
    run_with_retries,
    task,
)
from tallyfold.session import new_path


def counted(folder, fn):
    """``fn`` that leaves one file per call, since executors share no memory."""

    def run(params, context):
        name = f"{context.task_id}-{context.attempt}-{os.urandom(6).hex()}"
        (Path(folder) / name).touch()
        return fn(params, context)

    return run


def calls(folder):
    return len(list(Path(folder).iterdir()))


def runs(spark, n, name="job"):
    params = F.to_json(F.struct(F.col("id").alias("n")))
    return spark.range(n, numPartitions=4).select(
        F.col("id").cast("string").alias("task_id"),
        F.lit(name).alias("task_name"),
        params.alias("params"),
    )


def test_registration_is_checked():
    with pytest.raises(TypeError):
        task(name="a", retries=3)
    for bad in ({"name": " "}, {"name": "a", "max_attempts": 0}, {"name": "a", "queue": "é" * 29},
                {"name": "a", "max_delay_s": -1}):
        with pytest.raises(ConfigurationError):
            task(**bad)
    one = task(name="a")(lambda p, c: Ok())
    with pytest.raises(ConfigurationError, match="duplicate"):
        Registry([one, task(name="a")(lambda p, c: Ok())], "q")
    with pytest.raises(ConfigurationError, match="belongs"):
        Registry([task(name="b", queue="jobs")(lambda p, c: Ok())], "other")
    assert len(Registry([one], "q")) == 1


def test_outcomes(spark):
    def act(params, context):
        n = params["n"]
        if n == 0:
            return Ok({"n": n, "attempt": context.attempt})
        if n == 1:
            return Err({"why": "no"})
        if n == 2:
            raise KeyError("é" * 9000)
        if n == 3:
            return "done"
        if n == 4:
            return Ok(float("nan"))
        return Ok(None)

    registry = Registry([task(name="job")(act)], "q")
    rows = runs(spark, 6).withColumn("attempt", F.lit(2))
    rows = rows.unionByName(rows.where("task_id = '5'").selectExpr(
        "'other' AS task_id", "'unknown' AS task_name", "params", "attempt"))
    found = {r.task_id: r for r in run_tasks(rows, registry).collect()}
    assert json.loads(found["0"].result) == {"n": 0, "attempt": 2}
    assert found["1"].failure.name == "TaskError" and "why" in found["1"].failure.message
    assert found["2"].failure.name == "KeyError"
    assert len(found["2"].failure.message.encode()) <= 4096
    assert found["2"].failure.message.endswith("...")
    assert "Traceback" in found["2"].failure.stacktrace
    assert found["3"].failure.name == "RuntimeError" and found["3"].failure.stacktrace is None
    assert found["4"].state == "failed"
    assert (found["5"].state, found["5"].result) == ("completed", "null")
    assert found["other"].state == "deferred"


def test_wrapper_brackets_every_call(spark, tmp_path):
    def wrap(context, execute):
        (tmp_path / f"before-{context.task_id}").touch()
        result = execute()
        return Ok({"wrapped": result.value})

    registry = Registry([task(name="job")(lambda p, c: Ok(p["n"]))], "q")
    found = run_tasks(runs(spark, 3).withColumn("attempt", F.lit(1)), registry, wrap).collect()
    assert sorted(r.result for r in found) == [f'{{"wrapped": {i}}}' for i in range(3)]
    assert calls(tmp_path) == 3


def test_retries_run_only_failed_rows_and_resume(spark, tmp_path):
    def act(params, context):
        n = params["n"]
        if n % 3 == 0 and context.attempt < 3:
            raise RuntimeError("not yet")
        return Err("never") if n == 1 else Ok(context.attempt)

    registry = Registry([task(name="job", max_attempts=4)(counted(tmp_path, act))], "q")
    store = new_path(spark, "retries")
    rows = runs(spark, 9)
    found = {r.task_id: r for r in run_with_retries(rows, registry, store).collect()}
    assert {k: (r.state, r.attempt) for k, r in found.items()} == {
        str(n): ("failed", 4) if n == 1 else ("completed", 3 if n % 3 == 0 else 1)
        for n in range(9)
    }
    assert calls(tmp_path) == 9 + 4 + 4 + 1
    again = run_with_retries(rows, registry, store).collect()
    assert {r.task_id: r for r in again} == found
    assert calls(tmp_path) == 18


def test_unregistered_names_are_deferred(spark):
    registry = Registry([task(name="job")(lambda p, c: Ok(1))], "q")
    rows = runs(spark, 2).unionByName(runs(spark, 4, "later").where("task_id > '1'"))
    store = new_path(spark, "deferred")
    found = {r.task_id: r.state for r in run_with_retries(rows, registry, store).collect()}
    assert found == {"0": "completed", "1": "completed", "2": "deferred", "3": "deferred"}
    registry = Registry([*registry.tasks.values(), task(name="later")(lambda p, c: Ok(2))], "q")
    found = {r.task_id: r.state for r in run_with_retries(rows, registry, store).collect()}
    assert set(found.values()) == {"completed"}


def test_step_is_memoised_and_failures_leave_no_checkpoint(spark, tmp_path):
    store = new_path(spark, "steps")
    rows = runs(spark, 8).drop("task_name")
    flaky = counted(tmp_path, lambda p, c: Err("odd") if p["n"] % 2 else Ok(None))
    first = {r.task_id: r for r in durable_step(rows, "s", flaky, store).collect()}
    assert [first[str(n)].done for n in range(8)] == [n % 2 == 0 for n in range(8)]
    assert first["0"].value == "null"
    assert calls(tmp_path) == 8
    fixed = counted(tmp_path, lambda p, c: Ok(p["n"]))
    second = {r.task_id: r for r in durable_step(rows, "s", fixed, store).collect()}
    assert all(r.done for r in second.values())
    assert second["0"].value == "null" and second["1"].value == "1"
    assert calls(tmp_path) == 12
    durable_step(rows, "s", fixed, store).collect()
    assert calls(tmp_path) == 12
    other = durable_step(rows, "s2", fixed, store).collect()
    assert all(r.done for r in other) and calls(tmp_path) == 20


def test_a_lost_job_keeps_what_its_finished_tasks_wrote(spark, tmp_path):
    store = new_path(spark, "lost")
    rows = runs(spark, 40).drop("task_name")

    def dies(params, context):
        if params["n"] == 39:
            # Not an Exception: it ends the worker, as a lost executor does.
            import time

            time.sleep(5)
            os._exit(1)
        return Ok(params["n"])

    with pytest.raises(Exception):
        durable_step(rows, "s", dies, store, partitions=8)
    kept = spark.read.parquet(store).count()
    assert 0 < kept < 40
    done = durable_step(rows, "s", counted(tmp_path, lambda p, c: Ok(p["n"])), store).collect()
    assert all(r.done for r in done)
    assert calls(tmp_path) == 40 - kept
