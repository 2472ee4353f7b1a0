"""Compare a Spark result with a DuckDB result, ignoring row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*' if path.is_dir() else ''}'")
    return con


def _cell(value):
    """NaN equals NaN, but not NULL."""
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=_sort_key)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types' Python values and all rows agree."""
    cursor = con.execute(sql)
    names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return [f"columns {got_names} != {names}"]
    if len(got) != len(expected):
        return [f"{len(got)} rows != {len(expected)}"]
    bad = [(g, e) for g, e in zip(got, expected) if g != e or [type(x) for x in g] != [type(x) for x in e]]
    return [f"{len(bad)} rows differ, first: {bad[0]}"] if bad else []
