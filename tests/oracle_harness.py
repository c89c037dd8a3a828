"""Run a registered query in Spark and its oracle SQL in DuckDB; compare results.

Comparison: same column names, same row count, same multiset of rows after
normalising values (ints as ints, floats rounded, NaN/None as None, timestamps as
ISO strings). Columns are compared in sorted-name order, like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_con(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if str(type(v)).endswith("Timestamp'>"):
        return v.to_pydatetime().isoformat()
    return v


def _rows(records: list[tuple], order: list[int]) -> list[tuple]:
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duckdb_con(sf_dir)
    res = con.execute(oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out.update(spark_cols=s_cols, oracle_cols=d_cols, match=False)
        return out
    s_sorted = _rows(s_rows, [s_cols.index(c) for c in sorted(s_cols)])
    d_sorted = _rows(d_rows, [d_cols.index(c) for c in sorted(d_cols)])
    out["match"] = s_sorted == d_sorted
    if not out["match"]:
        diff_s = [r for r in s_sorted[:2000] if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted[:2000] if r not in set(s_sorted)][:3]
        out.update(sample_spark_only=diff_s, sample_oracle_only=diff_d, cols=sorted(s_cols))
    return out


if __name__ == "__main__":
    from keytally.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries
    con = duckdb_con(sf)
    bad = 0
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "match": False, "error": repr(e)[:500]}
        bad += not r.get("match")
        print(r, flush=True)
    print("MISMATCHES:", bad)
