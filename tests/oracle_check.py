"""Run registered queries in Spark and their DuckDB statements side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema (column names) and value-hash match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    from equitas.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, show=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return dict(name=name, rows=len(srows), oracle=False, sec=round(ts, 2))
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = (len(srows) == len(drows), sorted(scols) == sorted(dcols), sh == dh)
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows), rows_ok=ok[0],
               schema_ok=ok[1], hash_ok=ok[2], sec=round(ts, 2))
    if show and not all(ok):
        res["spark_cols"] = scols
        res["duck_cols"] = dcols
        sd, ss = set(dl), set(sl)
        diff_s = [x for x in sl if x not in sd][:5]
        diff_d = [x for x in dl if x not in ss][:5]
        res["only_spark"] = diff_s
        res["only_duck"] = diff_d
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from equitas.session import build_session
    spark = build_session(shuffle_partitions=8)
    con = connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir, show=True)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("error") or (r.get("oracle", True) and not (r.get("rows_ok") and r.get("schema_ok")
                                                            and r.get("hash_ok"))):
            bad += 1
        print(r, flush=True)
    print(f"mismatched or failed: {bad}")


if __name__ == "__main__":
    main()
