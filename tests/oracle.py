"""Runs a query on Spark and its SQL on DuckDB and compares names, types and rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return f"columns {names} / {sorted(described)}"
    types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if types != described:
        return f"types {types} / {described}"
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    want = sorted(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            close = isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12)
            if a != b and not close:
                return f"{dict(zip(names, g))} / {dict(zip(names, w))}"
    return None
