"""Spark query against its SQL twin on the same parquet files."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(table) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows as sorted text."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(repr(v) for v in row) for row in zip(*columns, strict=True)]
    return names, sorted(rows)


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    got_names, got = rows_of(df.toArrow())
    want_table = con.execute(sql).to_arrow_table()
    want_names, want = rows_of(want_table)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    types = {f.name: f.type for f in df.toArrow().schema}
    for f in want_table.schema:
        if str(types[f.name]).split("[")[0].replace("large_", "") != str(f.type).split("[")[0].replace("large_", ""):
            return f"type of {f.name}: {types[f.name]} != {f.type}"
    return None
