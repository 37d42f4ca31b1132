"""Run registered queries on Spark and their SQL on DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with details.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, digits=9):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}")
    if hasattr(v, "item"):
        return norm(v.item(), digits)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    return v


def rows_of(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"ROWS-ONLY {name}: {len(srows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"MISMATCH {name}: columns spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return f"MISMATCH {name}: rows spark={len(srows)} duck={len(drows)}"
    exact = rows_of(scols, srows, 17) == rows_of(dcols, drows, 17)
    if exact:
        return f"OK {name}: {len(srows)} rows exact ({t1 - t0:.1f}s)"
    a, b = rows_of(scols, srows, 9), rows_of(dcols, drows, 9)
    if a == b:
        return f"OK~ {name}: {len(srows)} rows equal to 9 digits ({t1 - t0:.1f}s)"
    diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return f"MISMATCH {name}: values; cols={sorted(scols)} first diffs={diffs}"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from panelkit.session import local_session
    import __spark_entry__ as ent
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = ent.queries(), ent.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            msg = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            msg = f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += msg.startswith(("MISMATCH", "ERROR"))
        print(msg, flush=True)
    print(f"done: {bad} failing of {len(names or qs)}")


if __name__ == "__main__":
    main()
