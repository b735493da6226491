"""Run every registered query in Spark and its oracle in DuckDB and compare results.

Usage: python tools/compare_oracle.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from pnlflow.plans import queries as Q  # noqa: E402

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
       "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:10] if not isinstance(v, dt.datetime) or v.time() == dt.time() else v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def rows_of(pdf) -> Counter:
    cols = sorted(pdf.columns)
    return Counter(tuple(canon(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(Q.REGISTRY)
    from pnlflow.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    oracle = Q.oracle_sql()
    bad = 0
    for n in names:
        t = time.time()
        s = Q.run(n, spark, sf_dir).toPandas()
        ts = time.time() - t
        if n not in oracle:
            print(f"{n:32s} spark_rows={len(s)} (no oracle) {ts:.1f}s")
            continue
        d = con.execute(oracle[n]).df()
        same_cols = sorted(s.columns) == sorted(d.columns)
        if same_cols:
            kinds = {c: (s[c].dtype.kind, d[c].dtype.kind) for c in s.columns}
            differ = {c: k for c, k in kinds.items() if k[0] != k[1] and len(s) and len(d)}
            if differ:
                print(f"   dtype kinds differ (spark, duckdb): {differ}")
        rs, rd = rows_of(s), rows_of(d) if same_cols else Counter()
        ok = same_cols and rs == rd
        bad += not ok
        print(f"{n:32s} {'OK ' if ok else 'BAD'} rows spark={len(s)} oracle={len(d)} {ts:.1f}s", flush=True)
        if not ok:
            if not same_cols:
                print("   columns:", sorted(s.columns), sorted(d.columns))
            else:
                only_s = list((rs - rd).elements())[:3]
                only_d = list((rd - rs).elements())[:3]
                print("   cols:", sorted(s.columns))
                print("   spark-only:", only_s)
                print("   oracle-only:", only_d)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
