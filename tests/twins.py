"""Rows of a query and of its SQL twin, comparable."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def rows(columns: list[str], found) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def compare(spark, query, sql: str, folder: str) -> None:
    df = query(spark, folder)
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        twin = con.sql(sql)
        columns, found = list(twin.columns), twin.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, found)
