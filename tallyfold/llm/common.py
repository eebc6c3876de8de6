"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch hands to Python; bounds what a worker holds at a time.
BATCH_ROWS = 512


def prepared(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, since one text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % divisor, F.lit(-1)).cast("int")


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a function that yields dicts of column lists in schema order."""
    names = [field.split()[0] for field in schema.split(",")]
    kinds = [_ARROW[field.split()[1]] for field in schema.split(",")]

    def run(batches):
        for columns in function(batches):
            arrays = [pa.array(columns[n], type=k) for n, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def keep_rows(
    df: DataFrame, columns: list[str], function: Callable[[pa.RecordBatch], list[bool]]
) -> DataFrame:
    """The rows of ``df``, all columns, for which ``function`` says so.

    ``function`` gets batches of ``columns``. Rows stay in their partitions; nothing is joined.
    """
    places = [df.columns.index(c) for c in columns]

    def run(batches):
        for batch in batches:
            mask = function(batch.select(places))
            yield batch.filter(pa.array(mask, type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
    "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string()),
}
