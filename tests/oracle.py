"""Compares a query's rows with those that DuckDB makes of its SQL, in any order, column names and values."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def from_duckdb(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    found = con.execute(sql)
    return rows_of([d[0] for d in found.description], found.fetchall())


def from_spark(df):
    return rows_of(df.columns, df.collect())
