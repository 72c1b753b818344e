"""Compare a Spark result with the DuckDB result of its SQL, value by value."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def differences(df, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)}, sql {sorted(names)}"]
    order = sorted(names)
    got = df.select(*order).collect()
    a = Counter(tuple(plain(v) for v in row) for row in got)
    at = [names.index(n) for n in order]
    b = Counter(tuple(plain(row[i]) for i in at) for row in want)
    out = []
    if a != b:
        out.append(f"rows: spark {len(got)}, sql {len(want)}")
        out += [f"only spark {x}" for x in list((a - b).keys())[:4]]
        out += [f"only sql {x}" for x in list((b - a).keys())[:4]]
    elif not want:
        out.append("both empty: the query tests nothing")
    return out


def plan_of(df) -> str:
    """Physical plan; after an action of ``df``, the one that ran."""
    return df._jdf.queryExecution().executedPlan().toString()
