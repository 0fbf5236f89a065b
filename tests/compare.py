"""Compare catalogue queries with their DuckDB twins: ``python tests/compare.py [sf] [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{DATA}/{sf}/{name}.parquet')")
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i] + 0.0 if isinstance(row[i], float) else row[i]) for i in order) for row in rows)


def difference(result, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if a DataFrame and a statement have the same columns and the same bag of rows."""
    table = result.toArrow()
    mine = rows_of(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])))
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(table.column_names):
        return f"columns {table.column_names} against {names}"
    if not theirs:
        return "the statement has no rows"
    if mine == theirs:
        return ""
    extra, missing = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
    return f"rows {mine.total()} against {theirs.total()}; extra {extra}; missing {missing}"


if __name__ == "__main__":
    from graphprep.plans.catalog import QUERIES
    from graphprep.plans.oracle import ORACLE
    from graphprep.workspace import local_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    database = connect(scale)
    for query in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            result = QUERIES[query](spark, f"{DATA}/{scale}")
            if query in ORACLE:
                outcome = difference(result, database, ORACLE[query]) or "ok"
            else:
                outcome = f"rows {result.count()}"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{query:28s} {time.time() - start:6.1f}s  {outcome}", flush=True)
