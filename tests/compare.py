"""Runs a registered query and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value) -> str:
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


SPARK_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean", "DOUBLE": "double",
}


def spark_type(duck_type: str) -> str:
    return SPARK_TYPE.get(duck_type, duck_type.lower())


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' when both have the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    duck_names = [d[0] for d in cursor.description]
    names = sorted(spark_df.columns)
    if names != sorted(duck_names):
        return f"columns differ: {sorted(set(names) ^ set(duck_names))}"
    kinds = dict(spark_df.dtypes)
    for name, described in zip(duck_names, cursor.description):
        if kinds[name] != spark_type(str(described[1])):
            return f"{name} is {kinds[name]} in Spark, {described[1]} in DuckDB"
    spark_rows = spark_df.select(*[f"`{n}`" for n in names]).collect()
    duck_rows = cursor.fetchall()
    at = [duck_names.index(n) for n in names]
    left = sorted(tuple(cell(v) for v in row) for row in spark_rows)
    right = sorted(tuple(cell(row[i]) for i in at) for row in duck_rows)
    if len(left) != len(right):
        return f"{len(left)} rows in Spark, {len(right)} in DuckDB"
    for a, b in zip(left, right):
        if a != b:
            return "; ".join(f"{n}: {x!r} / {y!r}" for n, x, y in zip(names, a, b) if x != y)
    return "" if left else "no rows"
