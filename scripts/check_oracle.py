"""Local oracle check: each registered Spark query vs its DuckDB SQL.

usage: python scripts/check_oracle.py [sf_dir] [key-substring ...]

Compares row count, column names and values (order-insensitive; doubles to
6 places, timestamps and dates as text). Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from panelkit.plans import catalog  # noqa: E402
from panelkit.session import local_session  # noqa: E402
from panelkit.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6) + 0.0
    if isinstance(v, (pd.Timestamp,)):
        d = v.to_pydatetime().replace(tzinfo=None)
        if d.hour == d.minute == d.second == d.microsecond == 0:
            return str(d.date())
        return str(d)
    if hasattr(v, "isoformat"):
        return str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    catalog.load_all()
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    ok = bad = 0
    for key, fn in catalog.QUERIES.items():
        if only and not any(o in key for o in only):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR spark {key}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = catalog.SQL.get(key)
        if sql is None:
            print(f"rows-only {key}: {len(sdf)} rows ({ts:.1f}s)")
            continue
        try:
            ddf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR sql {key}: {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        if sc != dc:
            print(f"MISMATCH cols {key}: spark={sc} duck={dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"MISMATCH rows {key}: spark={len(sr)} duck={len(dr)}")
            bad += 1
        elif sr != dr:
            diffs = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"MISMATCH values {key}: {len(sr)} rows; first diffs {diffs}")
            bad += 1
        else:
            ok += 1
            print(f"ok {key}: {len(sr)} rows ({ts:.1f}s)")
    print(f"== {ok} ok, {bad} bad")


if __name__ == "__main__":
    main()
