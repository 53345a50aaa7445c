"""Compare registered queries against their SQL twins in DuckDB (row count, columns, order-insensitive values).

    python -m critica.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s.replace("T", " ")
    return str(v)


def _digest(cols, rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str):
    import duckdb

    from critica.sources.tables import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    from critica.plans.oracle import ORACLE
    from critica.plans.queries import QUERIES

    con = duck(sf_dir)
    out = {}
    for name in names or sorted(QUERIES):
        rec = {}
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            rec["spark_rows"] = len(rows)
            rec["spark_sec"] = round(time.time() - t0, 2)
            if name in ORACLE:
                t1 = time.time()
                cur = con.execute(ORACLE[name])
                ocols = [d[0] for d in cur.description]
                orows = cur.fetchall()
                rec["oracle_sec"] = round(time.time() - t1, 2)
                rec["oracle_rows"] = len(orows)
                rec["cols_match"] = sorted(cols) == sorted(ocols)
                rec["match"] = rec["cols_match"] and _digest(cols, rows) == _digest(ocols, orows)
                if not rec["match"]:
                    rec["cols"] = (sorted(cols), sorted(ocols))
                    rec["sample"] = _first_diff(cols, rows, ocols, orows)
            else:
                rec["match"] = None
        except Exception as e:  # noqa: BLE001 - report and go on
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        out[name] = rec
        print(name, rec, flush=True)
    return out


def _first_diff(cols, rows, ocols, orows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = {"|".join(_norm(r[i]) for i in order) for r in rows}
    b = {"|".join(_norm(r[i]) for i in oorder) for r in orows}
    return {"spark_only": sorted(a - b)[:3], "oracle_only": sorted(b - a)[:3]}


if __name__ == "__main__":
    from critica.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("match") is False or "error" in v]
    print("MISMATCH/ERROR:", bad)
