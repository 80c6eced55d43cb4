"""Runs registered queries next to their SQL. Usage: python tests/oracle.py [sf] [name-prefix ...]"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}" if math.isfinite(value) else repr(value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(plain(row[i])) for i in order) for row in rows)), [names[i] for i in order]


def compare(spark, connection, name, query, folder):
    """Message that says how the results differ, or None."""
    start = time.time()
    df = query.run(spark, folder)
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - start
    if query.sql is None:
        return None, spent, 0.0, len(got)
    start = time.time()
    cursor = connection.execute(query.sql)
    want_names = [d[0] for d in cursor.description]
    want, want_names = rows_of(want_names, cursor.fetchall())
    other = time.time() - start
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", spent, other, len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", spent, other, len(got)
    if got != want:
        left = sorted(set(got) - set(want))[:3]
        right = sorted(set(want) - set(got))[:3]
        return f"values differ\n   columns {got_names}\n   spark {left}\n   sql   {right}", spent, other, len(got)
    return None, spent, other, len(got)


def main() -> None:
    from candor.plans.catalog import QUERIES
    from candor.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = local_session(8)
    connection = connect(folder)
    bad = 0
    for name, query in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        try:
            message, spent, other, count = compare(spark, connection, name, query, folder)
        except Exception as error:  # noqa: BLE001
            message, spent, other, count = f"{type(error).__name__}: {str(error)[:700]}", 0, 0, 0
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} rows={count} spark={spent:.2f}s sql={other:.2f}s {message or ''}", flush=True)
    print(f"{bad} bad of {sum(n.startswith(prefixes) for n in QUERIES)}")
    spark.stop()


if __name__ == "__main__":
    main()
