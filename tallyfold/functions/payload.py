"""JSON payloads, headers and terminal snapshots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import schemas as S


def is_json(text: Column) -> Column:
    """True for valid JSON; null is no payload and passes."""
    return text.isNull() | F.try_parse_json(text).isNotNull()


def field(value: Column, path: str, kind: str) -> Column:
    """The value at ``path`` of a variant; null where it is absent or does not fit the type."""
    return F.try_variant_get(value, path, kind)


def kind_of(value: Column) -> Column:
    """Type of a variant without what lies inside: ``OBJECT``, ``ARRAY``, ``BIGINT``, ``VOID``..."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def put_header(headers: Column, key: str, value: Column) -> Column:
    """``headers`` with one entry set; the new value replaces an old one."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_concat(F.coalesce(headers, empty), F.create_map(F.lit(key), value))


def merge_headers(headers: Column, more: Column) -> Column:
    """Union of two header maps in which ``more`` wins."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_concat(F.coalesce(headers, empty), F.coalesce(more, empty))


def encode_snapshot(state: Column, result: Column, failure: Column) -> Column:
    """A terminal snapshot as JSON with only the fields of its state; null when not terminal.

    ``result`` is JSON text and is stored as a value, not as a string.
    """
    value = F.coalesce(result, F.lit("null"))
    completed = F.concat(F.lit('{"state":"completed","result":'), value, F.lit("}"))
    failed = F.concat(
        F.lit('{"state":"failed","failure":'),
        F.coalesce(F.to_json(failure, {"ignoreNullFields": "false"}), F.lit("null")),
        F.lit("}"),
    )
    return (
        F.when(state == "completed", completed)
        .when(state == "failed", failed)
        .when(state == "cancelled", F.lit('{"state":"cancelled"}'))
    )


def decode_snapshot(text: Column) -> Column:
    """State, result (JSON text) and failure of an encoded snapshot; null for another shape."""
    parsed = F.try_parse_json(text)
    state = F.try_variant_get(parsed, "$.state", "string")
    result = F.to_json(F.try_variant_get(parsed, "$.result", "variant"))
    fields = [
        F.try_variant_get(parsed, f"$.failure.{name}", "string").alias(name)
        for name in S.FAILURE.names
    ]
    shaped = (
        ((state == "completed") & text.contains('"result"'))
        | ((state == "failed") & text.contains('"failure"'))
        | (state == "cancelled")
    )
    return F.when(
        shaped,
        F.struct(
            state.alias("state"),
            F.when(state == "completed", result).alias("result"),
            F.when(state == "failed", F.struct(*fields)).alias("failure"),
        ),
    )
