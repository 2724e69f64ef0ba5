"""Run a registered query and its SQL twin on one data folder and compare them."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns: list[str], rows: list) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
}


def compare(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """Differences in words; empty if the results are equal as multisets of typed rows."""
    df = run(spark, sf_dir)
    got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
    kinds = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    result = con.execute(sql)
    want_columns, want = normal([d[0] for d in result.description], result.fetchall())
    problems = []
    if got_columns != want_columns:
        problems.append(f"columns {got_columns} != {want_columns}")
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds.get(name):
            problems.append(f"type of {name}: {kind} != {kinds.get(name)}")
    if got != want:
        problems.append(f"rows {sum(got.values())} != {sum(want.values())} or values differ")
        problems += [f"  only spark: {r}" for r in list((got - want))[:3]]
        problems += [f"  only sql:   {r}" for r in list((want - got))[:3]]
    return problems
