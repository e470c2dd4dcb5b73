"""Compare registered queries with their oracle SQL: python tests/oracle_check.py [sf] [names...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if x is None:
        return None
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, bool):
        return x
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6g}" if abs(x) >= 1e6 else repr(round(x, 6) + 0.0)
    if isinstance(x, int):
        return str(x)
    return str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(_cell(r[i])) for i in order) for r in rows)


def compare(df, con, sql: str):
    spark_cols, spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    duck_cols, duck_rows = _rows([d[0] for d in cur.description], cur.fetchall())
    if spark_cols != duck_cols:
        return False, f"columns {spark_cols} vs {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return False, f"rows {len(spark_rows)} vs {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    return not bad, f"{len(spark_rows)} rows" if not bad else f"{len(bad)} differ, e.g. {bad[0]}"


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, oracles = connect(sf_dir), oracle_sql()
    failed = []
    for name, run in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                ok, note = compare(run(spark, sf_dir), con, oracles[name])
            else:
                rows = run(spark, sf_dir).collect()
                ok, note = bool(rows), f"{len(rows)} rows, no oracle"
        except Exception as exc:  # report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {note[:700]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
