"""Compare registered queries with their SQL: python tests/compare.py <sf_dir> [key ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows), [columns[i] for i in order]


def difference(spark_df, con, sql: str) -> str:
    """Empty if both give the same columns and the same rows, else what differs."""
    got, got_columns = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want, want_columns = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return ""
    extra = sorted(set(got) - set(want))[:1]
    missing = sorted(set(want) - set(got))[:1]
    at = 0
    if extra and missing:
        while at < min(len(extra[0]), len(missing[0])) and extra[0][at] == missing[0][at]:
            at += 1
    start = max(0, at - 200)
    return (
        f"{len(got)} rows against {len(want)}, {len(set(got) - set(want))} differ\n"
        f"  spark:  {[e[:60] + ' ... ' + e[start:at + 200] for e in extra]}\n"
        f"  duckdb: {[m[:60] + ' ... ' + m[start:at + 200] for m in missing]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for key, query in queries().items():
        if only and key not in only:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if key in oracles:
                problem = difference(df, con, oracles[key])
            else:
                problem = "" if df.count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = str(error)[:700]
        bad += bool(problem)
        note = "" if key in oracles else " (rows only)"
        print(f"{'DIFF' if problem else 'ok  '} {key}{note} {time.time() - started:.1f}s {problem}", flush=True)
    print(f"{bad} differ")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
