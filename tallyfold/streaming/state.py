"""State of a ``foreachBatch`` stream as folders numbered by batch.

A batch reads the folders before its own and replaces its own, so a batch that runs again
after a failure gives the same result. The folders live in the shared folder of the
cluster; everything between reading and writing is an ordinary distributed plan, in which
adaptive execution splits hot keys.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import schemas as S
from tallyfold.session import exists, read_or_empty

CLOCK = S.struct("seen timestamp")


def cached_batch(run):
    """Wrap a ``foreachBatch`` function so that its batch is read from the source once."""

    def cached(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            run(held, batch_id)
        finally:
            held.unpersist()

    return cached


def batch_before(spark: SparkSession, path: str, batch_id: int, schema: T.StructType, *parts: str) -> DataFrame:
    """What the batch before wrote below ``path``; only the first batch has none.

    A later batch without its predecessor would silently lose open state, for example under a
    new stream checkpoint over an old store or after a folder was removed, so it fails.
    """
    folder = f"{path}/batch={batch_id - 1}"
    if batch_id > 0 and not exists(spark, folder):
        raise FileNotFoundError(f"state of batch {batch_id - 1} is missing: {folder}")
    return read_or_empty(spark, "/".join([folder, *parts]), schema)


def write_batch(df: DataFrame, path: str, batch_id: int, *parts: str) -> None:
    df.write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/batch={batch_id}")


def clock_span(
    batch: DataFrame, column: str, path: str, batch_id: int, late_s: int
) -> tuple[Column, Column]:
    """The clock before and after the batch: the newest time seen less the allowed lateness."""
    spark = batch.sparkSession
    earlier = batch_before(spark, path, batch_id, CLOCK)
    before = earlier.agg(F.max("seen")).first()[0] or datetime(1970, 1, 1)
    newest = batch.agg(F.max(column)).first()[0] or before
    newest = max(before, newest)
    write_batch(spark.createDataFrame([(newest,)], CLOCK).coalesce(1), path, batch_id)
    late = timedelta(seconds=late_s)
    return F.lit(before - late), F.lit(newest - late)
