"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", value.normalize())
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(name):
    """Type families both engines share."""
    name = name.lower()
    for prefix, family in (
        ("decimal", "decimal"), ("bigint", "bigint"), ("int", "int"), ("double", "double"),
        ("timestamp", "timestamp"), ("date", "date"), ("bool", "boolean"),
        ("varchar", "string"), ("string", "string"), ("char", "string"),
    ):
        if name.startswith(prefix):
            return family
    return name


def spark_side(df):
    order = sorted(df.columns)
    types = dict(df.dtypes)
    rows = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    return order, [kind(types[c]) for c in order], rows


def duck_side(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    order = sorted(names)
    at = [names.index(c) for c in order]
    rows = Counter(tuple(plain(r[i]) for i in at) for r in result.fetchall())
    return order, [kind(types[i]) for i in at], rows
