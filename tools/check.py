"""Compare registered queries with their check SQL: ``python -m tools.check [sf] [key ...]``."""

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from stratloom.registry import all_oracles, all_queries
from stratloom.registry.fixtures import TABLES


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(repr(r[i]) for i in order) for r in rows]
    return sorted(out)


def compare(df, con, sql):
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"], len(got)
    for f in df.schema:
        t = f.dataType.simpleString()
        if SAME.get(t, t) != types[f.name]:
            problems.append(f"type {f.name}: {t} vs {types[f.name]}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} vs {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        only_a, only_b = sorted(sa - sb)[:3], sorted(sb - sa)[:3]
        problems.append(f"values differ: {len(sa - sb)} only in Spark, {len(sb - sa)} only in SQL\n   cols  {sorted(names)}"
                        + "".join(f"\n   spark {x}" for x in only_a) + "".join(f"\n   sql   {x}" for x in only_b))
    return problems, len(a)


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0.") else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(folder)
    qs, ors = all_queries(), all_oracles()
    keys = [k for k in qs if not args or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in args)]
    bad = 0
    for k in keys:
        t = time.time()
        try:
            df = qs[k](spark, folder)
            if k in ors:
                problems, n = compare(df, con, ors[k])
            else:
                problems, n = [], df.count()
        except Exception as e:
            problems, n = [f"{type(e).__name__}: {str(e)[:900]}"], -1
        state = "ok " if not problems else "BAD"
        bad += bool(problems)
        print(f"{state} {k} rows={n} {time.time() - t:.1f}s {'' if k in ors else '(rows only)'}", flush=True)
        for p in problems:
            print("   " + p, flush=True)
    print(f"{len(keys)} keys, {bad} bad")
    spark.stop()
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
