"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle.

usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def compare(sdf, odf):
    sc, oc = sorted(sdf.columns), sorted(odf.columns)
    if sc != oc:
        return f"columns differ: spark={sc} oracle={oc}"
    dt = [(c, str(sdf[c].dtype), str(odf[c].dtype)) for c in sc
          if len(sdf) and len(odf) and str(sdf[c].dtype).lower().rstrip("0123456789")
          != str(odf[c].dtype).lower().rstrip("0123456789") or (
              str(sdf[c].dtype) != str(odf[c].dtype) and "int" in str(sdf[c].dtype).lower()
              and "int" in str(odf[c].dtype).lower())]
    if dt:
        print(f"     dtype differences: {dt}")
    if len(sdf) != len(odf):
        return f"rows differ: spark={len(sdf)} oracle={len(odf)}"
    srows = sorted((tuple(_norm(r[c]) for c in sc) for r in sdf.to_dict("records")), key=repr)
    orows = sorted((tuple(_norm(r[c]) for c in sc) for r in odf.to_dict("records")), key=repr)
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return None


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv if not a.startswith("/")]
    import __spark_entry__ as E
    from shelfrank.session import get_spark
    spark = get_spark("local[8]")
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            fails += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS {name}: {len(sdf)} rows ({ts:.1f}s)")
            continue
        try:
            odf = con.sql(os_[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            fails += 1
            continue
        err = compare(sdf, odf)
        print(f"{'FAIL' if err else 'OK  '} {name}: {len(sdf)} rows ({ts:.1f}s){' ' + err if err else ''}")
        fails += bool(err)
    print(f"failures: {fails}")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
