"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", value.normalize())
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    ours = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    missing, extra = theirs - ours, ours - theirs
    assert not missing and not extra, (
        f"missing {sum(missing.values())}, e.g. {list(missing)[:3]}; extra {sum(extra.values())}, e.g. {list(extra)[:3]}"
    )
    return sum(ours.values())
