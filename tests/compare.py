"""Run registered queries against their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb

from tallyfold.queries.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, (bool, int, str, bytes, date, datetime, timedelta)) or value is None:
        return value
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return tuple(_plain(v) for v in value)


def normal_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def compare(df, con, text: str) -> list[str]:
    """Differences between a DataFrame and the SQL result; empty when they agree."""
    relation = con.sql(text)
    problems = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        expected = SPARK_TYPES.get(theirs[name])
        if expected and expected != kind:
            problems.append(f"type of {name}: {kind} != {theirs[name]}")
    ours = normal_rows(df.columns, df.collect())
    other = normal_rows(relation.columns, relation.fetchall())
    if len(ours) != len(other):
        problems.append(f"rows {len(ours)} != {len(other)}")
    bad = [(a, b) for a, b in zip(ours, other) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ; first {bad[0]}")
    return problems
