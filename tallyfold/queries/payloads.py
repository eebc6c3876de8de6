"""Results, failures and payloads as VARIANT: filters and counts by nested fields."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.payload import encode_snapshot, field
from tallyfold.queries.views import sql, view
from tallyfold.session import new_path
from tallyfold.sources.payloads import payload_shapes, read_payloads, with_variants, write_payloads

STORED = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("k", T.LongType()),
    ]
)


def payload_filter(spark, sf):
    """Ends of tasks by a field of their payload, from a stored table."""
    path = new_path(spark, "payloads")
    history = view(spark, sf, "transitions").select("queue", "seq", "op", "payload")
    parsed = with_variants(history, ["payload"])
    write_payloads(parsed, path, {"k": ("payload", "$.k", "bigint")})
    rows = read_payloads(spark, path, STORED)
    ends = rows.where((F.col("k") >= 60) & F.col("op").isin("complete", "fail"))
    half = (field(F.col("payload"), "$.k", "double") / 2).alias("half")
    absent = field(F.col("payload"), "$.k.none", "string").alias("absent")
    return ends.select("queue", "seq", "op", "k", half, absent)


def _snapshots(spark, sf):
    """A terminal snapshot per transition, as a variant; null where the task goes on."""
    rows = view(spark, sf, "transitions")
    state = (
        F.when(F.col("op") == "complete", "completed")
        .when(F.col("op") == "fail", "failed")
        .when(F.col("op") == "cancel", "cancelled")
    )
    failure = F.struct(
        F.col("task_name").alias("name"),
        F.col("payload").alias("message"),
        F.lit(None).cast("string").alias("stacktrace"),
    )
    text = encode_snapshot(state, F.col("payload"), failure)
    return with_variants(rows.select("queue", text.alias("snapshot")), ["snapshot"])


def snapshot_fields(spark, sf):
    """Results and failures per queue by fields nested in the snapshot."""
    snapshot = F.col("snapshot")
    k = field(snapshot, "$.result.k", "bigint")
    name = field(snapshot, "$.failure.name", "string")
    return (
        _snapshots(spark, sf)
        .where((k < 50) | name.endswith("7"))
        .groupBy("queue", field(snapshot, "$.state", "string").alias("state"))
        .agg(
            F.count(F.lit(1)).alias("found"),
            F.sum(k).alias("total"),
            F.min(name).alias("first_name"),
        )
    )


def snapshot_shapes(spark, sf):
    return payload_shapes(_snapshots(spark, sf), "snapshot", ["queue"])


QUERIES = {
    "payload_filter": (
        payload_filter,
        sql(
            "transitions",
            body="""SELECT queue, seq, op, k, k / 2.0::DOUBLE AS half, CAST(NULL AS VARCHAR) AS absent
                    FROM (SELECT *, CAST(json_extract_string(payload, '$.k') AS BIGINT) AS k
                          FROM transitions)
                    WHERE k >= 60 AND op IN ('complete', 'fail')""",
        ),
    ),
    "snapshot_fields": (
        snapshot_fields,
        sql(
            "transitions",
            body="""SELECT queue, state, count(*) AS found, CAST(sum(k) AS BIGINT) AS total,
                      min(name) AS first_name
                    FROM (SELECT queue,
                            CASE op WHEN 'complete' THEN 'completed' ELSE 'failed' END AS state,
                            CASE WHEN op = 'complete'
                                 THEN CAST(json_extract_string(payload, '$.k') AS BIGINT) END AS k,
                            CASE WHEN op = 'fail' THEN task_name END AS name
                          FROM transitions WHERE op IN ('complete', 'fail'))
                    WHERE k < 50 OR name LIKE '%7' GROUP BY ALL""",
        ),
    ),
    "snapshot_shapes": (
        snapshot_shapes,
        sql(
            "transitions",
            body="""SELECT queue, field, kind, count(*) AS found
                    FROM transitions LEFT JOIN (VALUES
                      ('complete', 'state', 'STRING'), ('complete', 'result', 'OBJECT'),
                      ('fail', 'state', 'STRING'), ('fail', 'failure', 'OBJECT'),
                      ('cancel', 'state', 'STRING')) s(of, field, kind) ON op = of
                    GROUP BY ALL""",
        ),
    ),
}
