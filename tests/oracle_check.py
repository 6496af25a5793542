"""Compare each registered query with its DuckDB oracle (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, sql: str, con) -> dict:
    sp = spark_df.toPandas()
    dk = con.execute(sql).df()
    res = {"rows_spark": len(sp), "rows_oracle": len(dk),
           "cols_match": sorted(sp.columns) == sorted(dk.columns)}
    if not res["cols_match"]:
        res["cols"] = (sorted(sp.columns), sorted(dk.columns))
        res["match"] = False
        return res
    a, b = _rows(sp), _rows(dk)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["only_spark"], res["only_oracle"] = diff_a, diff_b
    return res


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from marquee.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in os_:
                r = compare(df, os_[name], con)
            else:
                r = {"rows_spark": df.count(), "match": "rows-only"}
        except Exception as e:  # report and continue
            r = {"match": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t0, 2)
        if r["match"] is False:
            bad += 1
        print(name, r, flush=True)
    print("FAILED", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
