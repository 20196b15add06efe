"""Run registered queries next to their SQL twins.

    python tests/oracle.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, float)):
        return f"n{float(value)!r}"
    return f"s{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, name, run, sql, sf_dir):
    """Returns (problem or None, rows, seconds in Spark, seconds in SQL)."""
    start = time.time()
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    middle = time.time()
    if sql is None:
        return None, len(rows), middle - start, 0.0
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = result.fetchall()
    end = time.time()
    have_columns, have = canonical(df.columns, rows)
    want_columns, want = canonical(expected_columns, expected)
    problem = None
    if have_columns != want_columns:
        problem = f"columns {have_columns} != {want_columns}"
    elif len(have) != len(want):
        problem = f"{len(have)} rows != {len(want)}"
    elif have != want:
        different = [(h, w) for h, w in zip(have, want) if h != w]
        problem = f"{len(different)} rows differ, first {str(different[0])[:700]}"
    return problem, len(have), middle - start, end - middle


def make_session():
    from lexiloom.session import build_session

    spark = build_session(
        "lexiloom-check",
        master="local[8]",
        spark__ui__enabled="false",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry

    sf = argv[argv.index("--sf") + 1] if "--sf" in argv else "0.01"
    names = [a for i, a in enumerate(argv) if not a.startswith("--") and (i == 0 or argv[i - 1] != "--sf")]
    sf_dir = f"/root/testdata/sf{sf}"
    queries, sql = entry.queries(), entry.oracle_sql()
    spark, con = make_session(), connect(sf_dir)
    bad = []
    for name in names or list(queries):
        try:
            problem, rows, spark_s, sql_s = compare(spark, con, name, queries[name], sql.get(name), sf_dir)
        except Exception as error:
            problem, rows, spark_s, sql_s = f"{type(error).__name__}: {str(error)[:700]}", -1, 0.0, 0.0
        status = "ROWS" if problem is None and name not in sql else "ok" if problem is None else "BAD"
        print(f"{status:4} {name:28} rows={rows:<8} spark={spark_s:6.2f}s sql={sql_s:6.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} bad of {len(names or queries)}: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
