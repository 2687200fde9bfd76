"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
Parquet files, and compare column names, row counts and values (order
insensitive; floats compared after rounding).  Usable as a script:

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from ledgerlake.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm_value(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x, digits)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "asDict"):
        return _norm_value(v.asDict(), digits)
    if isinstance(v, bool):
        return int(v)
    return v


def normalise(rows: list[dict], digits: int = 6) -> list[tuple]:
    out = []
    for r in rows:
        out.append(tuple((k, _norm_value(r[k], digits)) for k in sorted(r)))
    return sorted(out, key=repr)


def _coarse(row):
    return tuple((k, round(v, 3) if isinstance(v, float) else v) for k, v in row)


def _close(x, y, rel=1e-7, abs_=1e-6):
    if len(x) != len(y):
        return False
    for (k1, v1), (k2, v2) in zip(x, y):
        if k1 != k2:
            return False
        if isinstance(v1, float) and isinstance(v2, (float, int)) or isinstance(v2, float) and isinstance(v1, int):
            if abs(v1 - v2) > max(abs_, rel * max(abs(v1), abs(v2))):
                return False
        elif isinstance(v1, tuple) and isinstance(v2, tuple):
            if not _close(tuple(enumerate(v1)), tuple(enumerate(v2)), rel, abs_):
                return False
        elif v1 != v2:
            return False
    return True


def compare(spark, name: str, sf_dir: str, con=None, digits: int = 5) -> dict:
    from ledgerlake.plans.registry import load_all
    reg = load_all()
    fn, sql = reg[name]
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(time.time() - t0, 2),
           "columns": sorted(sdf.columns)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    t0 = time.time()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    drows = [dict(zip(cols, r)) for r in cur.fetchall()]
    res["duck_rows"] = len(drows)
    res["duck_sec"] = round(time.time() - t0, 2)
    if sorted(cols) != sorted(sdf.columns):
        res["status"] = f"COLUMNS {sorted(sdf.columns)} vs {sorted(cols)}"
        return res
    if len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
        return res
    a, b = normalise(srows, 3), normalise(drows, 3)
    ka = [tuple((k, v) for k, v in r) for r in a]
    # Rows sorted on 3-digit keys, then compared with a relative tolerance,
    # so a value sitting on a rounding boundary does not count as a diff.
    sa = sorted(normalise(srows, 12), key=lambda r: repr(_coarse(r)))
    sb = sorted(normalise(drows, 12), key=lambda r: repr(_coarse(r)))
    bad = [(x, y) for x, y in zip(sa, sb) if not _close(x, y)]
    if not bad:
        res["status"] = "ok"
    else:
        res["status"] = f"VALUES ({len(bad)} differ)"
        res["example"] = repr(bad[0])[:600]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from ledgerlake.plans.registry import load_all
    from ledgerlake.session import local_session
    spark = local_session(8, 8)
    reg = load_all()
    con = duck(sf_dir)
    bad = 0
    for n in names or sorted(reg):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(names or reg)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
