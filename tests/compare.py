"""Compare registered queries with their SQL on the test tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    return names, sorted((tuple(r) for r in frame.select(*[f"`{n}`" for n in names]).collect()),
                         key=_key)


def difference(spark_frame, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    names, ours = rows_of(spark_frame)
    relation = con.sql(sql)
    theirs_names = sorted(relation.columns)
    if names != theirs_names:
        return f"columns {names} against {theirs_names}"
    at = [relation.columns.index(n) for n in theirs_names]
    theirs = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{names}: {a} against {b}"
    return None
