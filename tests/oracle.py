"""Runs a query and its oracle on the same tables and compares columns, row counts and values."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def normal_form(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cur = con.execute(sql)
    want_cols, want = normal_form([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = normal_form(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; first {got[:1]} / {want[:1]}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} != {w}"
    return None
