"""Compare queries with their SQL on the same parquet files.

``python tests/oracle.py [sf dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    left_cols, left = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    right_cols, right = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, first {bad[0][0]} != {bad[0][1]}"
    types = [(type(a), type(b)) for row in zip(left, right) for a, b in zip(*row) if type(a) is not type(b)]
    return f"types differ: {types[0]}" if types else None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from conftest import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session()
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    wanted = argv[1:] or list(entry.queries())
    failed = 0
    for name in wanted:
        started = time.perf_counter()
        try:
            df = entry.queries()[name](spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else None
            note = "rows only " + str(df.count()) if name not in sql else "ok"
        except Exception as failure:
            problem, note = f"{type(failure).__name__}: {str(failure)[:600]}", ""
        failed += problem is not None
        print(f"{name:34s} {time.perf_counter() - started:6.1f}s {'FAIL ' + problem if problem else note}", flush=True)
    print(f"{len(wanted)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
