"""Run registered queries next to their check SQL and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if sql is None:
        return True, f"rows {len(got[1])} (no SQL)", t1 - t0, 0.0
    rel = con.execute(sql)
    want = rows_of([c[0] for c in rel.description], rel.fetchall())
    t2 = time.time()
    if got == want:
        return len(want[1]) > 0, f"rows {len(want[1])}", t1 - t0, t2 - t1
    if got[0] != want[0]:
        return False, f"columns {got[0]} / {want[0]}", t1 - t0, t2 - t1
    a, b = set(got[1]), set(want[1])
    return False, (f"rows {len(got[1])} / {len(want[1])}; only spark {list(a - b)[:3]} ({len(a - b)}); "
                   f"only sql {list(b - a)[:3]} ({len(b - a)})"), t1 - t0, t2 - t1


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            ok, note, s, d = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # report and go on
            ok, note, s, d = False, f"{type(e).__name__}: {str(e)[:1500]}", 0, 0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} spark {s:.2f}s sql {d:.2f}s {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
