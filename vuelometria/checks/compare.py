"""Order-free comparison of a Spark result with the DuckDB result of its SQL counterpart."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, Decimal):
        return round(float(value), 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
}


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, [str(t) for t in relation.types]))
    ours = dict(result.dtypes)
    if set(ours) != set(theirs):
        return [f"columns {sorted(set(ours) ^ set(theirs))}"]
    out = [
        f"type of {c}: {ours[c]} vs {theirs[c]}" for c in sorted(ours) if _KINDS.get(theirs[c], theirs[c]) != ours[c]
    ]
    order = sorted(ours)
    a = Counter(tuple(_plain(row[c]) for c in order) for row in result.collect())
    picks = [relation.columns.index(c) for c in order]
    b = Counter(tuple(_plain(row[i]) for i in picks) for row in relation.fetchall())
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        out.append(f"rows {sum(a.values())} vs {sum(b.values())}; only spark {only_a}; only sql {only_b}; {order}")
    return out
