"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()[:19]
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(name: str) -> str:
    """Type names of both engines on one scale."""
    name = name.lower()
    for short, long in {"string": "varchar", "long": "bigint", "int": "integer", "short": "smallint"}.items():
        if name == short:
            return long
    return {"smallint": "smallint", "bigint": "bigint"}.get(name, name)


def spark_side(df):
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    return types, canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_side(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: kind(str(d[1])) for d in result.description}
    return types, canonical(columns, result.fetchall())
