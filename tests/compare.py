"""Run a registered query in Spark and its SQL twin in DuckDB, and compare the two results."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return repr(v)  # to the last bit, and the sign of zero
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


FAMILY = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    rel = con.sql(sql)
    found = []
    spark_types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    if spark_types != duck_types:
        odd = sorted(set(spark_types.items()) ^ set(duck_types.items()))
        found.append(f"schema: {odd}")
    if set(spark_types) != set(duck_types):
        return found
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    theirs = _bag(rel.columns, con.execute(sql).fetchall())
    if ours != theirs:
        found.append(f"rows: {sum(ours.values())} against {sum(theirs.values())}")
        names = sorted(df.columns)
        found += [f"  only ours   {dict(zip(names, r))}" for r in list((ours - theirs))[:3]]
        found += [f"  only theirs {dict(zip(names, r))}" for r in list((theirs - ours))[:3]]
    return found
