"""Run registered queries against their SQL on one set of tables."""

from __future__ import annotations

import sys
import time

import duckdb

from checks import oracle, registry
from martloom.session import build_session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        return f"{v:.9g}" if isinstance(v, float) else f"{v:d}" if isinstance(v, int) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main(sf_dir: str, only: list[str]) -> int:
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    statements, failed = oracle.statements(), 0
    for name, query in registry.queries().items():
        if only and name not in only:
            continue
        try:
            t0 = time.time()
            df = query(spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in statements:
                print(f"{name:28} rows only {len(got)}  {t1 - t0:.2f}s")
                continue
            cur = duck.execute(statements[name])
            names = [d[0] for d in cur.description]
            want = cur.fetchall()
            t2 = time.time()
            a, b = canonical(got, df.columns), canonical(want, names)
            same = a == b and sorted(df.columns) == sorted(names)
            failed += not same
            print(f"{name:28} {'ok' if same else 'DIFF'} rows {len(got)}/{len(want)}  spark {t1 - t0:.2f}s"
                  f"  sql {t2 - t1:.2f}s", flush=True)
            if not same:
                print("   columns", sorted(set(df.columns) ^ set(names)))
                extra, lost = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
                print("   names  ", sorted(names)[:12])
                print("   only spark", extra)
                print("   only sql  ", lost)
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name:28} ERROR {type(e).__name__}: {str(e)[:600]}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
