"""Compare registered queries with their SQL: ``python tests/check_oracle.py [folder] [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame = frame.assign(**{name: column.astype("datetime64[us]")})
        elif pd.api.types.is_numeric_dtype(column):
            frame = frame.assign(**{name: column.astype("float64")})
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = normal(got), normal(want)
    for name in got.columns:
        a, b = got[name], want[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = int((~same).values.argmax())
            return f"{name}: {(~same).sum()} differ, first {a[at]!r} against {b[at]!r}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(folder)
    statements, bad = oracle_sql(), 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            got = query(spark, folder).toPandas()
            spent = time.time() - start
            problem = differences(got, con.sql(statements[name]).df()) if name in statements else "(rows only)"
        except Exception as error:
            spent, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
            got = []
        bad += bool(problem) and problem != "(rows only)"
        print(f"{name:32s} {len(got):7d} rows {spent:6.2f}s {problem or 'ok'}", flush=True)
    print("queries not equal:", bad)


if __name__ == "__main__":
    main()
