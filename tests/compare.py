"""Compare a query with its SQL restatement as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, str, bytes)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    return int(value) if isinstance(value, int) else value


def bag(rows, names) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return bag([tuple(r) for r in df.collect()], df.columns)


def duck_bag(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return bag(result.fetchall(), names)
