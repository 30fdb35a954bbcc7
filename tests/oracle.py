"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return "nan" if f != f else repr(round(f, 6) + 0.0)
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    df = run(spark, sf_dir)
    cols, rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    ocols, orows = canon([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} != {ocols}"
    if rows != orows:
        left, right = set(rows) - set(orows), set(orows) - set(rows)
        return f"rows {len(rows)} vs {len(orows)}; only spark {sorted(left)[:3]}; only sql {sorted(right)[:3]}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from conftest import session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (sys.argv[1:] or queries):
        start = time.time()
        try:
            if name in sqls:
                text = compare(spark, con, queries[name], sqls[name], sf)
                state = "ok" if not text else "DIFF " + text
            else:
                state = f"rows {len(queries[name](spark, sf).collect())}"
        except Exception as e:  # a report, not a test
            state = "ERROR " + str(e)[:1500]
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{time.time() - start:6.2f}s {name}: {state}", flush=True)
    print("bad", bad)
