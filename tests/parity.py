"""Spark-vs-DuckDB parity helper (same idea as the driver's check).

Run as a script: ``python tests/parity.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    d = con.sql(sql).df()
    out = {"name": name, "spark_rows": len(s), "duck_rows": len(d), "spark_sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(s.columns) == sorted(d.columns)
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s.columns), sorted(d.columns)
        out["ok"] = False
        return out
    rs, rd = _rows(s), _rows(d)
    out["ok"] = rs == rd
    if not out["ok"]:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        out["first_diffs"] = diff
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from loanlens.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(sqls):
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "ok": False, "error": repr(exc)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
