"""Compares each registered query with its SQL run by DuckDB on the same tables."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    rows = df[sorted(df.columns)].astype(object).itertuples(index=False)
    return sorted(tuple(str(v) for v in row) for row in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    got = fn(spark, sf_dir).toPandas()
    if sql is None:
        return ""
    want = con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and "datetime" not in k[0] and "str" not in k[1]}
    a, b = normal(got), normal(want)
    if a != b:
        extra, missing = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"{len(a)} / {len(b)} rows; only here {extra}; only there {missing}"
    return f"types {odd}" if odd else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from rillrank.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                             "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, fn, sql.get(name), sf_dir)
        except Exception as e:  # report and go on
            result = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {result or 'ok'}{'' if name in sql else ' (no SQL)'} {time.time() - start:.2f}s", flush=True)
