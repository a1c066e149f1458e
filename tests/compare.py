"""Spark result against DuckDB result, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns differ: {sorted(df.columns)} / {sorted(relation.columns)}"]
    ours, theirs = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    out = [f"rows: {sum(ours.values())} / {sum(theirs.values())}"] if ours != theirs else []
    out += [f"only spark: {r}" for r in list((ours - theirs))[:3]]
    out += [f"only duckdb: {r}" for r in list((theirs - ours))[:3]]
    return out
