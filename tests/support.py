"""Row-for-row comparison of a Spark frame with DuckDB's answer."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (dt.date, str, bool)) or value is None:
        return str(value)
    if isinstance(value, Decimal):
        return str(float(value))
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {
        "int": ("integer", "int"),
        "bigint": ("bigint", "long"),
        "double": ("double", "float"),
        "text": ("varchar", "string"),
        "date": ("date",),
        "timestamp": ("timestamp",),
        "boolean": ("boolean",),
        "decimal": ("decimal",),
    }.items():
        if name.startswith(words):
            return kind
    return name


def spark_answer(df):
    columns = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    return columns, kinds, Counter(tuple(_cell(row[c]) for c in columns) for row in df.select(*columns).collect())


def duckdb_answer(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: _kind(str(d[1])) for d in cursor.description}
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), kinds, Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())
