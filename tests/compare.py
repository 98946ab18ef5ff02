"""Run registered queries beside their SQL twins and compare the rows.

Usage: python tests/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return value


def row_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), row_bag(df.columns, (tuple(r) for r in df.collect()))


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), row_bag(columns, cursor.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from weatherloom.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            columns, got = spark_rows(query(spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            print(f"ERROR  {name}: {str(error)[:1500]}")
            failed += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows   {name}: {sum(got.values())} rows, {took:.1f}s")
            continue
        try:
            want_columns, want = sql_rows(con, sql[name])
        except Exception as error:  # noqa: BLE001
            print(f"SQLERR {name}: {str(error)[:1500]}")
            failed += 1
            continue
        if columns != want_columns or got != want:
            failed += 1
            print(f"DIFFER {name}: {sum(got.values())} / {sum(want.values())} rows\n  {columns}\n  {want_columns}")
            print("  only here:", list((got - want).items())[:3], "\n  only SQL: ", list((want - got).items())[:3])
        else:
            print(f"equal  {name}: {sum(got.values())} rows, {took:.1f}s")
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])))
