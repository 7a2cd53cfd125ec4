"""Compare Spark results with the SQL counterparts run by DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def kind(declared: str) -> str:
    """Type families that must agree."""
    declared = declared.lower()
    for prefix, family in (
        ("bigint", "bigint"), ("int", "int"), ("smallint", "smallint"), ("decimal", "decimal"), ("double", "double"),
        ("varchar", "text"), ("string", "text"), ("date", "date"), ("timestamp", "timestamp"), ("bool", "boolean"), ("hugeint", "hugeint"),
    ):
        if declared == prefix or (declared.startswith(prefix) and prefix not in ("date", "int")):
            return family
    return "int" if declared == "integer" else declared


def difference(frame, connection, sql: str) -> str | None:
    """None when both sides agree in columns, types and rows, else what differs."""
    cursor = connection.execute(sql)
    names, kinds = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    expected = cursor.fetchall()
    columns = frame.columns
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} <> {sorted(names)}"
    ours = {f.name: kind(f.dataType.simpleString()) for f in frame.schema.fields}
    theirs = {n: kind(k) for n, k in zip(names, kinds)}
    if ours != theirs:
        return f"types {sorted(set(ours.items()) ^ set(theirs.items()))}"
    got, want = sorted_rows(columns, frame.collect()), sorted_rows(names, expected)
    if got == want:
        return None
    extra = [r for r in got if r not in want][:3] if len(got) < 5000 else []
    missing = [r for r in want if r not in got][:3] if len(got) < 5000 else []
    if not extra and not missing:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"rows {len(got)} <> {len(want)}; {pairs}"
    return f"rows {len(got)} <> {len(want)}; {sorted(columns)}; only ours {extra}; only theirs {missing}"
