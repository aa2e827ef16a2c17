"""Runs catalogue queries beside their SQL and compares columns, kinds and values.

``python -m tests.compare [folder] [query ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value):
    if isinstance(value, bool) or value is None:
        return type(value).__name__
    if isinstance(value, decimal.Decimal):
        return "decimal"
    return type(value).__name__


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name, build, sql, sf_dir):
    """None when equal, else a text that says where the results part."""
    df = build(spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = normal(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}; e.g. {ours[:1]} / {theirs[:1]}"
    for a, b in zip(ours, theirs):
        if a != b or [kind(x) for x in a] != [kind(x) for x in b]:
            return f"{sorted(columns)}\n   ours {a}\n   sql  {b}"
    return None


def main(argv):
    import __spark_entry__ as e
    from tests.session import session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session()
    con = duck(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    names = argv[1:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], sqls.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}",
              flush=True)
    print(f"{len(names)} queries, {bad} differ; without SQL: {sorted(set(queries) - set(sqls))}; "
          f"SQL only: {sorted(set(sqls) - set(queries))}")


if __name__ == "__main__":
    main(sys.argv[1:])
