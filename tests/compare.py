"""Run registered queries against their SQL checks in DuckDB.

python tests/compare.py [folder] [name ...]
"""

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    """A comparable form; doubles keep 12 significant digits."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isnan(value):
            return "NaN"
        return f"{value:.12g}"
    if isinstance(value, int):
        return f"{float(value):.12g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql):
    """Empty when both results agree, else a short description."""
    left = table(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    right = table([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns differ: only spark {set(left[0]) - set(right[0])}, only sql {set(right[0]) - set(left[0])}"
    if len(left[1]) != len(right[1]):
        return f"rows differ: spark {len(left[1])}, sql {len(right[1])}"
    off = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if off:
        cells = [(left[0][i], x, y) for i, (x, y) in enumerate(zip(*off[0])) if x != y]
        return f"{len(off)} of {len(left[1])} rows differ, first: {cells[:4]}"
    if not left[1]:
        return "no rows"
    return ""


def main(folder="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from spendgrid.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, checks = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in checks:
                problem = differences(df, con, checks[name])
            else:
                rows = df.collect()
                problem = "" if rows else "no rows"
                if rows and len(rows) <= 12:
                    print(*rows[:6], sep="\n")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:36}{time.time() - start:7.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
