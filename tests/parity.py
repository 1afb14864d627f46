"""Compares every query with its SQL: row count, column names, values regardless of row order."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(row[i]) for i in order) for row in rows], key=repr)


def difference(spark_df, con, sql) -> str | None:
    """What differs, or None."""
    ours = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} != {other}"
    kinds = [{type(v) for row in side for v in row if v is not None} for side in (ours, theirs)]
    return None if kinds[0] == kinds[1] else f"types {kinds[0]} != {kinds[1]}"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = session()
    con = connect(folder)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            found = difference(query(spark, folder), con, oracles[name])
        except Exception as problem:  # noqa: BLE001 - the list goes on after a failing query
            found = f"{type(problem).__name__} {str(problem)[:600]}"
        print(f"{name:28s} {time.time() - began:6.1f}s {found or 'ok'}", flush=True)
