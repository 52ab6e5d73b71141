"""Run queries and compare them with their SQL: python -m checks.run [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from carelake.session import local_session
from checks.oracles import all_oracles
from checks.queries import all_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    out = {}
    for c in sorted(frame.columns):
        col = frame[c]
        if "datetime" in str(col.dtype):
            out[c] = col.astype("datetime64[us]").astype(str)
        else:
            out[c] = [
                "NULL" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v)
                else repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool)
                else str(v)[:10] if str(v).endswith("00:00:00") and len(str(v)) == 19
                else str(v)
                for v in col.astype(object)
            ]
        out[c] = ["NULL" if v in ("NaT", "nan", "None") else v.removesuffix(" 00:00:00") for v in out[c]]
    done = pd.DataFrame(out)
    return done.sort_values(list(done.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"ROWS {len(got)} <> {len(want)}"
    a, b = plain(got), plain(want)
    for c in a.columns:
        different = a[c].values != b[c].values
        if different.any():
            i = different.argmax()
            return f"VALUES {c}: {different.sum()} rows, e.g. {a.iloc[i].to_dict()} <> {b.iloc[i].to_dict()}"
    return "ok"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark, con = local_session(8), connect(sf_dir)
    oracles, failed = all_oracles(), 0
    for name in names:
        start = time.time()
        try:
            got = all_queries()[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            verdict = compare(got, con.execute(oracles[name]).df()) if name in oracles else f"no SQL, {len(got)} rows"
        except Exception as failure:
            seconds, verdict = time.time() - start, f"ERROR {type(failure).__name__}: {str(failure)[:1500]}"
        failed += verdict != "ok" and not verdict.startswith("no SQL")
        print(f"{name:32s} {seconds:6.2f}s  {len(got) if 'got' in dir() else 0:8d}  {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
