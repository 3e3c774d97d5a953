"""Run registered queries against their SQL: `python tests/check_oracle.py [sf_dir] [name ...]`."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(float(value))


def compare(got_columns, got, want_columns, want) -> str:
    """Empty if both results hold the same rows, else what differs."""
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} / {sorted(want_columns)}"
    def rows(columns, data):
        place = [columns.index(c) for c in sorted(columns)]
        return sorted(tuple(normal(r[p]) for p in place) for r in data)
    a, b = rows(list(got_columns), got), rows(list(want_columns), want)
    if len(a) != len(b):
        return f"{len(a)} rows / {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def check(spark, con, sf_dir, name, fn, sql) -> tuple[str, int]:
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return ("" if got else "no rows"), len(got)
    cur = con.execute(sql)
    return compare(df.columns, got, [d[0] for d in cur.description], cur.fetchall()), len(got)


def main():
    import __spark_entry__ as e
    from pixwave.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(sf_dir), e.queries(), e.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            message, n = check(spark, con, sf_dir, name, queries[name], oracle.get(name))
        except Exception as err:
            message, n = f"{type(err).__name__}: {str(err)[:1500]}", 0
        failed += bool(message)
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if message else 'ok  '} {kind} {name} {n} rows {time.time() - t:.1f}s {message}", flush=True)
    print(f"{failed} failed; SQL without query: {set(oracle) - set(queries)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
