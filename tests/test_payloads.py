"""VARIANT payloads: odd values, stored tables, and what a scan reads."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.payload import field
from tallyfold.session import new_path
from tallyfold.sources.payloads import payload_shapes, read_payloads, with_variants, write_payloads

VALUES = [
    ("a", 1, '{"k": 5, "deep": {"x": {"y": "z"}}, "list": [1, 2]}'),
    ("a", 2, '{"k": "text"}'),
    ("a", 3, "[1]"),
    ("b", 4, "null"),
    ("b", 5, None),
    ("b", 6, "{broken"),
    ("b", 7, ""),
    ("b", 8, "{}"),
    ("b", 9, '{"k": 1, "k": 70}'),
    (None, 10, '{"k": 99999999999999999999}'),
]


def parsed(spark):
    return with_variants(spark.createDataFrame(VALUES, "queue string, id int, v string"), ["v"])


def by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_bad_text_is_named_and_null_is_not(spark):
    bad = by_id(parsed(spark), "bad_payloads")
    assert {i for i, names in bad.items() if names} == {6, 7}
    assert bad[6] == ["v"]


def test_fields_that_do_not_fit_are_null(spark):
    rows = parsed(spark).select(
        "id",
        field(F.col("v"), "$.k", "bigint").alias("k"),
        field(F.col("v"), "$.deep.x.y", "string").alias("y"),
        field(F.col("v"), "$.list[1]", "int").alias("second"),
    )
    assert {i: k for i, k in by_id(rows, "k").items() if k is not None} == {1: 5, 9: 70}
    assert by_id(rows, "y")[1] == "z" and by_id(rows, "second")[1] == 2


def test_header_maps_become_objects(spark):
    rows = spark.createDataFrame([(1, {"t": "x"}), (2, None)], "id int, headers map<string,string>")
    found = with_variants(rows, maps=["headers"])
    assert by_id(found.select("id", field(F.col("headers"), "$.t", "string").alias("t")), "t") == {
        1: "x",
        2: None,
    }
    assert by_id(found, "bad_payloads") == {1: [], 2: []}


def test_shapes(spark):
    found = payload_shapes(parsed(spark), "v", ["queue"])
    rows = {(r.queue, r.field, r.kind): r.found for r in found.collect()}
    assert rows == {
        ("a", "k", "BIGINT"): 1,
        ("a", "deep", "OBJECT"): 1,
        ("a", "list", "ARRAY"): 1,
        ("a", "k", "STRING"): 1,
        ("a", None, "ARRAY"): 1,
        ("b", None, "VOID"): 1,
        ("b", None, None): 3,
        ("b", None, "OBJECT"): 1,
        ("b", "k", "BIGINT"): 1,
        (None, "k", "DECIMAL"): 1,
    }
    empty = payload_shapes(parsed(spark).limit(0), "v", ["queue"])
    assert empty.collect() == []


def test_stored_values_come_back_and_the_scan_reads_one_path(spark):
    path = new_path(spark, "variants")
    write_payloads(parsed(spark), path, {"k": ("v", "$.k", "bigint")})
    schema = T.StructType(
        [
            T.StructField("queue", T.StringType()),
            T.StructField("id", T.IntegerType()),
            T.StructField("v", T.VariantType()),
            T.StructField("k", T.LongType()),
        ]
    )
    stored = read_payloads(spark, path, schema)
    text = F.to_json("v").alias("text")
    assert by_id(stored.select("id", text), "text") == by_id(parsed(spark).select("id", text), "text")
    hit = stored.where(F.col("k") >= 10).select("id", field(F.col("v"), "$.k", "bigint").alias("n"))
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,10)" in plan
    assert "v:struct<0:bigint>" in plan  # one path of the variant, not the whole value
    assert by_id(hit, "n") == {9: 70}
