"""Run a query on Spark and its SQL on DuckDB and compare the rows, in any order."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, float):
        return repr(value)
    return str(value) if value is not None else "\0"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    expected = con.sql(sql)
    want = rows_of(expected.columns, expected.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if sorted(spark_df.columns) != sorted(expected.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected.columns)}"
    if want == got:
        return None
    from collections import Counter

    more, less = Counter(got) - Counter(want), Counter(want) - Counter(got)
    return (
        f"{len(got)} rows, expected {len(want)}; "
        f"extra {list(more)[:2]}; missing {list(less)[:2]}"
    )
