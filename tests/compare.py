"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, repr(float(v) + 0.0))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(_cell(r[i]) for i in order) for r in rows))


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean"}


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and values agree."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    out = []
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    for name, kind in df.dtypes:
        if kind != types[name]:
            out.append(f"type of {name}: {kind} != {types[name]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
