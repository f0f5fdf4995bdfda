"""Runs a registered query in Spark and its oracle in DuckDB and compares names and values."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, f, sql: str, sf_dir: str) -> list[str]:
    """What differs; empty if nothing does."""
    df = f(spark, sf_dir)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return [f"{name}: columns {sorted(df.columns)} and {sorted(names)}"]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    odd = [f"{name}: {c} is {k} and {kinds[c]}" for c, k in df.dtypes if KINDS.get(k) != kinds[c]]
    got, want = _rows(df.columns, df.collect()), _rows(names, cur.fetchall())
    if got != want:
        extra, missing = [r for r in got if r not in want][:3], [r for r in want if r not in got][:3]
        odd.append(f"{name}: {len(got)} and {len(want)} rows; only Spark: {extra}; only oracle: {missing}")
    elif not got:
        odd.append(f"{name}: no rows")
    return odd
