"""Run registered queries next to their SQL and compare all values.

Usage: python tests/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    plain.sort(key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))
    return [names[i] for i in order], plain


def spark_result(df):
    return canonical(df.columns, df.collect())


def sql_result(con, sql: str):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> str:
    """Empty when equal, else what differs."""
    got = spark_result(fn(spark, sf_dir))
    if sql is None:
        return "" if got[1] else "no rows"
    want = sql_result(con, sql)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else ""


def main() -> None:
    import __spark_entry__ as entry
    from fettle.plans.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark, con, sql = local_session(8), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, fn, sql.get(name))
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in sql else "rows")
        print(f"{mark} {name} {time.time() - start:.2f}s {problem[:700]}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
