"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (float, decimal.Decimal)):
        return "nan" if x != x else float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return [plain(y) for y in x]
    return x


def rows_of(rows, names) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same rows and column names."""
    got = rows_of([tuple(r) for r in spark_df.collect()], spark_df.columns)
    rel = con.sql(sql)
    want = rows_of(rel.fetchall(), rel.columns)
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(bad)} of {len(got)} rows differ: {bad[:2]}" if bad else ""
