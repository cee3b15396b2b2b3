"""Compare a query with its SQL check, by name, type class and value."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def duck(folder: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    if name.startswith("timestamp"):
        return "timestamp"
    return {"string": "varchar", "int": "integer", "float": "real"}.get(name, name)


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; empty when the results are equal."""
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: kind(str(d[1])) for d in cursor.description}
    theirs = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(set(df.columns) ^ set(names))}")
        return found
    for name, spark_kind in df.dtypes:
        if kind(spark_kind) != kinds[name]:
            found.append(f"type of {name}: {spark_kind} against {kinds[name]}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} against {len(theirs)}")
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
