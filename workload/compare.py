"""Run a query and its SQL counterpart side by side and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import numpy as np


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool | np.bool_):
        return bool(value)
    if isinstance(value, int | np.integer):
        return float(value)
    if isinstance(value, decimal.Decimal | float | np.floating):
        return None if math.isnan(value) else round(float(value), 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if isinstance(value, list | tuple | np.ndarray):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


FAMILIES = {
    "whole": {"tinyint", "smallint", "int", "integer", "bigint"},
    "real": {"float", "double"},
    "text": {"string", "varchar"},
    "flag": {"boolean"},
}


def family(kind: str) -> str:
    return next((f for f, kinds in FAMILIES.items() if kind.lower() in kinds), kind.lower())


def type_difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Columns whose kind of type (whole, real, text, flag) differs between both sides."""
    theirs = {r[0]: family(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {n: family(k) for n, k in df.dtypes}
    odd = {n: (k, theirs.get(n)) for n, k in mine.items() if theirs.get(n) != k}
    return f"types {odd}" if odd else None


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns and rows, else a short description."""
    if odd := type_difference(df, con, sql):
        return odd
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1], strict=True):
        if a != b:
            return f"row {a}\n !=  {b}"
    return None
