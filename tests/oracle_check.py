"""Compare registered queries with their SQL: python tests/oracle_check.py SF_DIR [NAME ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


def difference(spark, query, sql: str, connection, sf_dir: str) -> str:
    """'' when names, types of numbers and values agree."""
    df = query(spark, sf_dir)
    got = sorted_rows(df.collect(), df.columns)
    relation = connection.sql(sql)
    names = relation.columns
    want = sorted_rows(relation.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} != {w}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
             "string": "VARCHAR", "boolean": "BOOLEAN"}
    spark_types = {n: kinds.get(t, t) for n, t in df.dtypes}
    sql_types = {n: str(t) for n, t in zip(names, relation.types)}
    if spark_types != sql_types:
        return f"types {spark_types} != {sql_types}"
    return ""


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as contract

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = make_session()
    connection = connect(sf_dir)
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries), set(sql) - set(queries)
    failures = 0
    for name, query in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, query, sql[name], connection, sf_dir)
                label = "ok" if not problem else "DIFF " + problem
            else:
                label = f"no SQL, {query(spark, sf_dir).count()} rows"
                problem = ""
        except Exception as error:
            problem = label = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        failures += bool(problem)
        print(f"RESULT {name:36s} {time.time() - start:6.2f}s {label}", flush=True)
    print(f"RESULT {failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main())
