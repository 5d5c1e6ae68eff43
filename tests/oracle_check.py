"""Run registry queries in Spark and their SQL in DuckDB, compare results.

Comparison: row count, column names, and the multiset of rows (columns sorted
by name; floats compared exactly after the rounding both sides apply).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark, name: str, sf_dir: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = [tuple(r) for r in rel.fetchall()]
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = "row count differs"
        return res
    if a != b:
        bad = next(i for i in range(len(a)) if a[i] != b[i])
        res["status"] = f"values differ at {bad}: spark={a[bad]} oracle={b[bad]}"
        return res
    res["status"] = "match"
    return res


def main(argv):
    import __spark_entry__ as E
    from ludeme.plans.session import local_session

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, name, sf_dir, qs[name], sqls.get(name), con)
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
