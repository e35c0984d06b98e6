"""Compare a Spark result with DuckDB on the same parquet files, whole and order-free."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    mine = dict(df.dtypes)
    if set(theirs) != set(mine):
        return f"columns: {sorted(set(theirs) ^ set(mine))}"
    cols = sorted(mine)
    wrong = [f"{c} {mine[c]}/{theirs[c]}" for c in cols if KIND.get(mine[c]) != theirs[c]]
    if wrong:
        return f"types: {wrong}"
    a = sorted(tuple(map(cell, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    quoted = ", ".join(f'"{c}"' for c in cols)
    b = sorted(tuple(map(cell, r)) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(a) != len(b):
        return f"rows: {len(a)} against {len(b)}; only here {list(set(a) - set(b))[:2]}, only there {list(set(b) - set(a))[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {dict(zip(cols, x))} against {dict(zip(cols, y))}"
    return None
