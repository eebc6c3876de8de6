"""History with its JSON columns stored as VARIANT.

Spark shreds the fields that most values share into typed Parquet columns, and a query that
asks for one path reads only that part of the value. Fields that many queries filter by can
also be named: they become columns of their own, whose statistics let a scan skip files and
row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.payload import field, kind_of


def with_variants(
    df: DataFrame, texts: list[str] | None = None, maps: list[str] | None = None
) -> DataFrame:
    """JSON text columns and map columns as VARIANT, and ``bad_payloads``.

    Text that is not JSON (empty text too) becomes null and its column is named in
    ``bad_payloads``; null text stays null and is not bad. JSON ``null`` is a value, a variant
    null. Of an object that repeats a key the last value counts.
    """
    texts, maps = texts or [], maps or []
    bad = [F.when(F.col(c).isNotNull() & F.try_parse_json(c).isNull(), F.lit(c)) for c in texts]
    empty = F.array().cast("array<string>")
    marked = df.withColumn("bad_payloads", F.array_compact(F.array(*bad)) if bad else empty)
    return marked.withColumns(
        {c: F.try_parse_json(c) for c in texts} | {c: F.to_variant_object(F.col(c)) for c in maps}
    )


def write_payloads(
    df: DataFrame,
    path: str,
    fields: dict[str, tuple[str, str, str]] | None = None,
    partition_by: tuple[str, ...] = ("queue",),
    mode: str = "append",
) -> None:
    """Write a table with VARIANT columns, partitioned, with typed columns for ``fields``.

    ``fields`` maps a new column to (variant column, path, type). A value that has no such
    path, or of which the field does not fit the type, gives null there and stays whole in
    the variant. Rows are sorted by these columns within a file, so that statistics tell
    files and row groups apart.
    """
    named = {n: field(F.col(c), at, kind) for n, (c, at, kind) in (fields or {}).items()}
    rows = df.withColumns(named).hint("rebalance", *partition_by)
    if named:
        rows = rows.sortWithinPartitions(*partition_by, *named)
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_payloads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read under a fixed schema; name the columns of ``fields`` in it to filter by them."""
    return spark.read.schema(schema).parquet(path)


def payload_shapes(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """How often each top-level field of a variant column occurs, by its type.

    An object gives a row per key. Any other value, an empty object too, counts once with a
    null ``field`` and its own type: ``VOID`` for a JSON null, null where there is no value.
    """
    value = F.col(column)
    entries = F.explode_outer(F.try_variant_get(value, "$", "map<string,variant>"))
    pairs = df.select(*by, kind_of(value).alias("_whole"), entries.alias("field", "_value"))
    kind = F.when(F.col("field").isNull(), F.col("_whole")).otherwise(kind_of(F.col("_value")))
    return pairs.groupBy(*by, "field", kind.alias("kind")).agg(F.count(F.lit(1)).alias("found"))
