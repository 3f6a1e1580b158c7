"""Compare registered queries with their SQL in DuckDB: ``python -m ratingmill.plans.check [sf] [names]``."""

from __future__ import annotations

import math
import sys
import time

from ratingmill.session import build_session, clear_staged

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def main(folder: str, only: list[str]) -> int:
    import duckdb

    from ratingmill.plans import all_queries

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, q in all_queries().items():
        if only and name not in only:
            continue
        try:
            start = time.time()
            df = q.run(spark, folder)
            got = df.collect()
            took = time.time() - start
            clear_staged(spark)
            if q.sql is None:
                print(f"rows {name}: {len(got)} rows, {took:.1f} s", flush=True)
                continue
            start = time.time()
            cur = con.execute(q.sql)
            names = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = cur.fetchall()
            duck = time.time() - start
            a, b = rows_of(df.columns, got), rows_of(names, want)
            ok = sorted(df.columns) == sorted(names) and a == b
            failed += not ok
            print(f"{'ok  ' if ok else 'FAIL'} {name}: {len(a)} rows, spark {took:.1f} s, duckdb {duck:.1f} s", flush=True)
            kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
            odd = {c: (t, types.get(c)) for c, t in df.dtypes if types.get(c) not in (kinds.get(t), "NUMBER")}
            odd = {c: v for c, v in odd.items() if v[1] != kinds.get(v[0])}
            if odd:
                print("     types", odd, flush=True)
            if not ok:
                print("    ", sorted(df.columns), sorted(names), len(a), len(b))
                sa, sb = set(a), set(b)
                print("     spark only", [x for x in a if x not in sb][:3])
                print("     duckdb only", [x for x in b if x not in sa][:3], flush=True)
        except Exception as error:  # keep going, report at the end
            failed += 1
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:600]}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args[0] if args else "sf0.01"
    sys.exit(bool(main(f"/root/testdata/{sf}", args[1:])))
