"""Compare a registered query with its SQL twin in DuckDB, as multisets of rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return f"{v + 0.0:.6f}"
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return str(v)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """A list of what differs, empty if nothing does."""
    names, rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    sql_names, sql_rows = canonical([d[0] for d in found.description], found.fetchall())
    if names != sql_names:
        return [f"columns {names} != {sql_names}"]
    if len(rows) != len(sql_rows):
        return [f"rows {len(rows)} != {len(sql_rows)}"]
    pairs = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    return [f"{len(pairs)} rows, e.g. {a} != {b}" for a, b in pairs[:1]]
