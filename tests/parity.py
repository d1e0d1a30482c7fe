"""Run queries next to their SQL in DuckDB: ``python -m tests.parity [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from adoptrend.plans.catalog import QUERIES, SQL
from adoptrend.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.01")


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Spark type -> DuckDB type
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, connection, name: str, folder: str, queries=QUERIES, sql=SQL) -> tuple[str, str]:
    start = time.time()
    df = queries[name](spark, folder)
    left = table(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in sql:
        return "rows", f"{len(left[1])} rows, {took:.1f}s"
    start = time.time()
    result = connection.execute(sql[name])
    right = table([d[0] for d in result.description], result.fetchall())
    note = f"{len(left[1])} rows, {took:.1f}s, sql {time.time() - start:.1f}s"
    if left[0] != right[0]:
        return "COLUMNS", f"{left[0]} / {right[0]}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    other = {c: (k, kinds[c]) for c, k in df.dtypes if TYPES.get(k) != kinds[c]}
    if other:
        return "TYPES", str(other)
    if len(left[1]) != len(right[1]):
        return "COUNT", f"{len(left[1])} / {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if wrong:
        return "VALUES", f"{len(wrong)} differ, e.g. {wrong[0]}"
    return ("EMPTY" if not left[1] else "ok"), note


def main(names: list[str]) -> int:
    spark = build_session("local[8]", "parity")
    connection = oracle(FOLDER)
    bad = 0
    for name in names or sorted(QUERIES):
        try:
            verdict, note = compare(spark, connection, name, FOLDER)
        except Exception as error:  # one broken query must not hide the others
            verdict, note = "ERROR", f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in ("ok", "rows")
        print(f"{verdict:8} {name:28} {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
