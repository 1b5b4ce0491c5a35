"""Run one registered query on Spark and its SQL on DuckDB and compare rows as multisets."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _plain(value):
    return value.normalize() if isinstance(value, Decimal) else value


def differences(spark_df, con, sql: str) -> list[str]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_rows = rel.fetchall()
    out = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: {sorted(set(names) ^ set(spark_df.columns))}"]
    got_rows = [tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()]
    got = Counter(tuple(map(_plain, r)) for r in got_rows)
    want = Counter(tuple(map(_plain, r)) for r in want_rows)
    if got != want:
        out.append(f"rows {len(got_rows)} / {len(want_rows)}")
        out += [f"only spark: {dict(zip(names, r))}" for r in list((got - want))[:2]]
        out += [f"only sql: {dict(zip(names, r))}" for r in list((want - got))[:2]]
    return out
