"""Parquet tables with a fixed schema, a version mark and optional partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import schemas as S
from tallyfold.session import written

STORAGE_MODES = ("unpartitioned", "partitioned")
#: Partitions that one overwrite names in its filter.
PARTITIONS_AT_ONCE = 200


class SchemaMismatch(ValueError):
    """The stored table was written under another schema version."""


def write_history(
    df: DataFrame,
    path: str,
    storage_mode: str = "unpartitioned",
    day_of: str = "ts",
    mode: str = "append",
) -> None:
    """Append rows by queue, or by queue and day.

    The rebalance hint gathers the rows of a partition into few files, while adaptive
    execution still splits a hot queue over as many tasks as its size needs.
    """
    if storage_mode not in STORAGE_MODES:
        raise ValueError(f"storage_mode must be one of {STORAGE_MODES}")
    parts = ["queue"]
    rows = df.withColumn("schema_version", F.lit(S.SCHEMA_VERSION))
    if storage_mode == "partitioned":
        rows = rows.withColumn("day", F.to_date(day_of))
        parts.append("day")
    rows.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).parquet(path)


def read_history(
    spark: SparkSession,
    path: str,
    table: str,
    queue: str | None = None,
    as_of: Column | None = None,
    time_column: str = "ts",
    storage_mode: str = "unpartitioned",
) -> DataFrame:
    """Read a history table under its fixed schema and refuse another schema version.

    The queue filter prunes partitions, and in a table that is partitioned by the day of
    ``time_column`` so does ``as_of``. The version check reads one small column, and its
    filter reaches the files' statistics.
    """
    schema = S.TABLES[table]
    marked = S.copy_of(schema).add("schema_version", "string")
    if storage_mode == "partitioned":
        marked = marked.add("day", "date")
    stored = spark.read.schema(marked).parquet(path)
    if queue is not None:
        stored = stored.where(F.col("queue") == queue)
    version = F.col("schema_version")
    other = (version != S.SCHEMA_VERSION) | version.isNull()
    found = stored.where(other).select("schema_version").limit(1).collect()
    if found:
        raise SchemaMismatch(f"expected {S.SCHEMA_VERSION}, found {found[0][0]}")
    if as_of is not None:
        stored = stored.where(F.col(time_column) <= as_of)
        if storage_mode == "partitioned":
            stored = stored.where(F.col("day") <= F.to_date(as_of))
    return stored.select(*schema.names)


def _partition_columns(storage_mode: str) -> list[str]:
    return ["queue", "day"] if storage_mode == "partitioned" else ["queue"]


def _within(values: list, names: list[str]) -> Column:
    """Rows of any of these partitions; literals, so that the scan prunes the others."""
    by_queue: dict = {}
    for row in values:
        by_queue.setdefault(row["queue"], []).append(row)
    found = F.lit(False)
    for queue, rows in by_queue.items():
        here = F.col("queue").eqNullSafe(F.lit(queue))
        if "day" in names:
            days = [r["day"] for r in rows]
            known = [d for d in days if d is not None]
            hit = F.col("day").isin(known) if known else F.lit(False)
            here &= (F.col("day").isNull() | hit) if None in days else hit
        found |= here
    return found


def _remove_folders(spark: SparkSession, stored: DataFrame) -> None:
    """Delete the partition folders that the rows of ``stored`` lie in."""
    files = stored.select(F.col("_metadata.file_path").alias("file")).distinct()
    folders = files.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    jvm = spark._jvm
    for row in folders.collect():  # a row per partition
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.folder))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_rows(
    spark: SparkSession,
    path: str,
    table: str,
    deleted: DataFrame,
    keys: list[str],
    storage_mode: str = "unpartitioned",
) -> int:
    """Take the rows whose ``keys`` are in ``deleted`` out of a stored table.

    Only partitions that lose rows are rewritten, by dynamic overwrite; all other files stay
    as they are. A partition that loses all its rows goes with its folder (a queue whose last day
    goes may leave an empty one). Returns how many partitions changed. Null keys match nothing, and the deleted keys may repeat. What stays of
    a partition is written to the shared folder before it replaces the old files. The
    partitions are replaced in blocks, not all at one instant: a reader between two may still
    see rows to be deleted, a removal that was cut short is repeated with the same keys, and
    removals of one table must not run side by side.
    """
    parts = _partition_columns(storage_mode)
    marked = S.copy_of(S.TABLES[table]).add("schema_version", "string")
    if storage_mode == "partitioned":
        marked = marked.add("day", "date")
    stored = spark.read.schema(marked).parquet(path)
    gone = written(deleted.select(*keys).distinct(), "gone")
    lost = written(stored.join(gone, keys, "left_semi").select(*parts).distinct(), "lost-parts")
    hit = lost.collect()  # a row per partition, which the driver lists anyway
    for at in range(0, len(hit), PARTITIONS_AT_ONCE):
        block = hit[at : at + PARTITIONS_AT_ONCE]
        touched = stored.where(_within(block, parts))
        left = written(touched.join(gone, keys, "left_anti").select(*marked.names), "left-rows")
        full = {tuple(r) for r in left.select(*parts).distinct().collect()}
        empty = [row for row in block if tuple(row) not in full]
        if empty:
            _remove_folders(spark, stored.where(_within(empty, parts)))
        if full:
            left.hint("rebalance", *parts).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(*parts).parquet(path)
    return len(hit)


def drop_stored_queues(spark: SparkSession, path: str, table: str, queues: DataFrame) -> int:
    """Delete the folders of queues from a stored table; unknown names are no error.

    Reads no rows but the names of the files. Returns how many queues were there.
    """
    stored = spark.read.schema(S.TABLES[table]).parquet(path)
    names = queues.select("queue").distinct().collect()  # a name per dropped queue
    found = 0
    for at in range(0, len(names), PARTITIONS_AT_ONCE):
        doomed = stored.where(_within(names[at : at + PARTITIONS_AT_ONCE], ["queue"]))
        found += doomed.select("queue").distinct().count()
        _remove_folders(spark, doomed)
    return found
