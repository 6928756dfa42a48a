"""Runs a registered query beside its SQL and compares the rows as bags."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"t:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value if value is None else f"{type(value).__name__}:{value}"


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return bag(df.columns, df.collect())


def duck_bag(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return bag(columns, cursor.fetchall())


def difference(left, right, n: int = 3) -> str:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if not only_left and not only_right:
        return ""
    return (
        f"rows {sum(left[1].values())} vs {sum(right[1].values())}; "
        f"only spark {list(only_left.items())[:n]}; only sql {list(only_right.items())[:n]}"
    )
