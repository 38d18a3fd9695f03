"""Run a query and its SQL on the same files and compare the results as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TESTDATA = os.environ.get("TABLEWARD_TESTDATA", "/root/testdata")


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, run, sql, con=None):
    df = run(spark, sf_dir)
    con = con or connection(sf_dir)
    want = con.execute(sql)
    want_names = [d[0] for d in want.description]
    wanted = rows_of(want_names, want.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(df.columns) != sorted(want_names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(want_names)}")
    if len(got) != len(wanted):
        problems.append(f"rows {len(got)} != {len(wanted)}")
    if not problems and [repr(r) for r in got] != [repr(r) for r in wanted]:
        diff = [(g, w) for g, w in zip(got, wanted) if repr(g) != repr(w)]
        problems.append(f"{len(diff)} rows differ, e.g. {diff[0]}")
    return problems, len(got)
