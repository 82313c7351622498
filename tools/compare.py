"""Run bound queries next to their SQL counterparts and report differences.

usage: python tools/compare.py SF_DIR [module|module:query ...]
"""

from __future__ import annotations

import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from linkloom import bindings
from linkloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if value is None:
        return "~"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), sorted(columns)


def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir, name, query, sql):
    start = time.time()
    frame = query(spark, sf_dir)
    columns = frame.columns
    rows = [tuple(r) for r in frame.collect()]
    spark_time = time.time() - start
    got, got_names = canonical(columns, rows)
    if sql is None:
        return f"rows-only {len(rows)} rows {spark_time:.1f}s", True
    start = time.time()
    result = connection.execute(sql)
    want_columns = [c[0] for c in result.description]
    want_types = dict(zip(want_columns, [str(c[1]) for c in result.description]))
    want, want_names = canonical(want_columns, result.fetchall())
    duck_time = time.time() - start
    if got_names != want_names:
        return f"COLUMNS {got_names} <> {want_names}", False
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
    off = {n: (kinds[n], want_types[n]) for n in got_names if same.get(kinds[n], kinds[n]) != want_types[n]}
    note = f" types {off}" if off else ""
    if got != want:
        a, b = set(got), set(want)
        only_a, only_b = sorted(a - b)[:3], sorted(b - a)[:3]
        short = lambda rs: [tuple(v[:80] for v in r) for r in rs]
        return f"DIFF {len(got)} vs {len(want)} rows; spark-only {len(a - b)} {short(only_a)} sql-only {len(b - a)} {short(only_b)}{note}", False
    return f"ok {len(got)} rows spark {spark_time:.1f}s sql {duck_time:.1f}s{note}", True


def main():
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    queries, oracles = {}, {}
    for item in wanted or bindings.MODULES:
        name, _, only = item.partition(":")
        module = importlib.import_module(f"linkloom.bindings.{name}")
        queries.update({q: f for q, f in module.QUERIES.items() if only in ("", q)})
        oracles.update(module.ORACLES)
    spark, connection = local_session(8), duck(sf_dir)
    failed = []
    for name, query in queries.items():
        try:
            text, good = compare(spark, connection, sf_dir, name, query, oracles.get(name))
        except Exception as error:  # report and go on
            text, good = f"ERROR {type(error).__name__} {str(error)[:900]}", False
        if not good:
            failed.append(name)
        print(f"{name:28s} {text}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
