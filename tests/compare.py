"""Compare registered queries with their DuckDB statements: compare.py <sf_dir> [key ...]"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if value is None:
        return ("0",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("n", "nan") if math.isnan(value) else ("d", value)
    if isinstance(value, decimal.Decimal):
        return ("dec", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    return ("s", str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


def difference(spark_df, con, sql) -> str | None:
    """None when names, types of values and values agree, else a short description."""
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_names, want = rows_of(names, result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from lectern.session import build_session

    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    con = duck(sys.argv[1])
    failed = 0
    for key in sys.argv[2:] or queries:
        start = time.time()
        df = queries[key](spark, sys.argv[1])
        if key not in sql:
            print(f"{key:32s} rows only {df.count()}  {time.time() - start:.2f}s", flush=True)
            continue
        problem = difference(df, con, sql[key])
        failed += problem is not None
        print(f"{key:32s} {problem or 'ok'}  {time.time() - start:.2f}s "
              f"{con.execute(f'SELECT count(*) FROM ({sql[key]})').fetchall()[0][0]} rows",
              flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
