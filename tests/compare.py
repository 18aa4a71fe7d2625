"""Run a query in Spark and its SQL in DuckDB, and compare rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
