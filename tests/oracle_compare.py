"""Row-exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _counted(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v).__name__, v) for v in (_plain(r[i]) for i in order)) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, value types and rows are the same."""
    relation = con.sql(sql)
    ours, theirs = list(spark_df.columns), list(relation.columns)
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(set(ours) ^ set(theirs))} differ"]
    a = _counted(ours, [tuple(r) for r in spark_df.collect()])
    b = _counted(theirs, relation.fetchall())
    if not b:
        return ["the oracle has no rows"]
    out = []
    if a != b:
        out.append(f"{sum(a.values())} rows against {sum(b.values())}")
        out += [f"only here: {r}" for r in list((a - b))[:2]] + [f"only oracle: {r}" for r in list((b - a))[:2]]
    return out
