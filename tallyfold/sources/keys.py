"""Keys that were seen before, in buckets, so that a lookup moves only the new rows."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.plans.ranges import covering
from tallyfold.session import exists, written

BUCKETS = 64


class KeyTable:
    """Rows by key, appended in numbered batches and stored bucketed and sorted by the key.

    A lookup sends the distinct new keys to the buckets, or to every task where they are few;
    the stored side is never shuffled. Batches are merged in the ranges of a binary counter,
    so a table of ``n`` batches has at most ``log2(n) + 1`` live parts of ``buckets`` files.
    A batch that is appended again replaces its part. Rows with a null in the key are not
    stored and not found. ``buckets`` is fixed when the table is created: choose it so that a
    bucket of the final table fits a task. Keys should be unique: a repeated one comes back
    as often as it was stored. Parts that a merge replaced stay on disk for replays.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.buckets = list(keys), buckets
        self.name = f"keys_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{key}`" for key in keys)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, `_last` INT, `_first` INT) "
            f"USING parquet PARTITIONED BY (`_last`, `_first`) CLUSTERED BY ({by}) "
            f"SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        if exists(spark, path):
            # Another session may have written parts that this catalog does not list yet.
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def _parts(self, ranges: list[tuple[int, int]]) -> DataFrame:
        part = [(F.col("_first") == first) & (F.col("_last") == last) for first, last in ranges]
        chosen = reduce(Column.__or__, part, F.lit(False))
        return self.spark.table(self.name).where(chosen).select(*self.schema.names)

    def _check(self, batch_id: int) -> None:
        have = {
            tuple(int(item.split("=")[1]) for item in row[0].split("/"))
            for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        }  # a row per part
        lost = [r for r in covering(batch_id) if r[::-1] not in have]
        if lost:
            raise FileNotFoundError(f"batches {lost} are missing in {self.path}")

    def rows(self, batch_id: int) -> DataFrame:
        """All rows of batches 0 to ``batch_id``; a missing batch is an error."""
        self._check(batch_id)
        return self._parts(covering(batch_id))

    def find(self, wanted: DataFrame, batch_id: int) -> DataFrame:
        """The stored rows of batches 0 to ``batch_id`` whose key is in ``wanted``.

        ``wanted`` may repeat keys and hold nulls. Its distinct keys are written first: that
        gives their true size, and leaves the buckets as the only partitioning to join by.
        """
        asked = wanted.select(*self.keys).na.drop().distinct()
        stored = self.rows(batch_id)
        return stored.join(written(asked, "asked-keys"), self.keys)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Store batch ``batch_id``, merged with the parts that its number completes.

        Every batch needs the one before it, also when it brings no rows.
        """
        first, last = covering(batch_id)[-1]
        self._check(batch_id - 1)
        old = self._parts([r for r in covering(batch_id - 1) if r[0] >= first])
        new = rows.select(*self.schema.names).na.drop(subset=self.keys)
        whole = written(old.unionByName(new), "key-part")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (_last = {last}, _first = {first}) "
            "SELECT * FROM {rows}",
            rows=whole.repartition(self.buckets, *self.keys),
        )
        if whole.isEmpty():  # an insert without rows may leave no partition behind
            self.spark.sql(
                f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION (_last = {last}, _first = {first})"
            )
