"""Run every registered query next to its SQL twin and compare the rows without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if (Path(folder) / f"{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else number


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    ours = normalised(df.columns, df.collect())
    theirs = normalised(relation.columns, relation.fetchall())
    if ours == theirs:
        return []
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return [
        f"rows {len(ours)} vs {len(theirs)}", f"columns {sorted(df.columns)}",
        f"ours {sorted(only_ours, key=repr)[:3]}", f"theirs {sorted(only_theirs, key=repr)[:3]}",
    ]
