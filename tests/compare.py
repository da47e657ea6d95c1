"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("%.9g" % (value + 0.0))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (list, tuple)):
        return [_cell(v) for v in value]
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr([_cell(r[i]) for i in order]) for r in rows))


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names, wanted = rows_of([d[0] for d in cur.description], cur.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    if got == wanted:
        return None
    extra, missing = set(got) - set(wanted), set(wanted) - set(got)
    return f"{len(got)} rows, {len(wanted)} wanted; extra {sorted(extra)[:2]}; missing {sorted(missing)[:2]}"
