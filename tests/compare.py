"""Runs registered queries next to their SQL and compares rows: ``python tests/compare.py DIR [name ...]``."""

from __future__ import annotations

import datetime
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def compare(spark, sf_dir, name, query, sql):
    """(error text or '', number of rows)."""
    df = query(spark, sf_dir)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "", len(got)
    expected_columns, expected = oracle_rows(sf_dir, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}", len(got)
    if got != expected:
        extra, missing = sorted(set(got) - set(expected)), sorted(set(expected) - set(got))
        return f"{len(got)} rows, expected {len(expected)}; got {extra[:2]} expected {missing[:2]} of {columns}", len(got)
    return "", len(got)


if __name__ == "__main__":
    from conftest import session

    import __spark_entry__ as contract

    spark = session()
    oracle = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, sys.argv[1], name, query, oracle.get(name))
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} {n} rows {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)
