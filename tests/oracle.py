"""Run a query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean"}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, rows. Empty when all is equal."""
    found = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {row[0]: KINDS.get(row[1], row[1]) for row in described}
    if sorted(want_types) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(want_types)}"]
    got_types = dict(df.dtypes)
    for name, kind in want_types.items():
        if got_types[name] != kind:
            found.append(f"type of {name}: {got_types[name]} != {kind}")
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    want = bag([r[0] for r in described], con.execute(sql).fetchall())
    if got != want:
        extra, missing = got - want, want - got
        found.append(
            f"rows {got.total()} vs {want.total()};"
            f" extra {extra.total()} {list(extra)[:3]}; missing {missing.total()} {list(missing)[:3]}"
        )
    return found
