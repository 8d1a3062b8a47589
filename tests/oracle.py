"""Run a registered query and its SQL side by side and compare rows regardless of order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def norm(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if hasattr(v, "date") and not isinstance(v, str):
            v = v.date() if getattr(v, "hour", 0) == getattr(v, "minute", 0) == getattr(v, "second", 0) == 0 else v
        if isinstance(v, float):
            return f"{v:.6f}" if v != int(v) else str(int(v))
        return str(v)

    cols = sorted(df.columns)
    return sorted(tuple(one(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))


def compare(spark_df, con, sql: str) -> str | None:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = norm(got), norm(want)
    if a == b:
        return None
    only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"{len(a)} and {len(b)} rows; only here {only[0]}; only in SQL {only[1]}"
