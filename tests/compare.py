"""Runs a named query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def oracle_rows(con, sql):
    done = con.execute(sql)
    columns = [c[0] for c in done.description]
    return normal(columns, done.fetchall())


def oracle_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_differences(df, con, sql):
    want = oracle_types(con, sql)
    got = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return {c: (got.get(c), want.get(c)) for c in set(got) | set(want) if got.get(c) != want.get(c)}
