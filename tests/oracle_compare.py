"""Run a registered query in Spark and its SQL oracle in DuckDB and compare.

Usable from pytest and from the command line::

    python -m tests.oracle_compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    odf = con.execute(E.oracle_sql()[name]).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(sdf), "oracle_rows": len(odf),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    res["columns_match"] = sorted(sdf.columns) == sorted(odf.columns)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(sdf.columns), sorted(odf.columns)
        res["match"] = False
        return res
    a, b = _rows(sdf), _rows(odf)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from linecast.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [k for k in E.queries() if k in E.oracle_sql()]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "match": False, "error": repr(exc)[:500]}
        bad += not r.get("match")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
