"""Compares query results with DuckDB on the same tables."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _key(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    """Empty text when both agree, else what differs."""
    result = con.execute(sql)
    want_columns, want = rows([d[0] for d in result.description], result.fetchall())
    columns, got = rows(df.columns, [tuple(r) for r in df.collect()])
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(got) != len(want):
        extra, missing = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"{len(got)} rows, expected {len(want)}; extra {extra}, missing {missing}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ""
