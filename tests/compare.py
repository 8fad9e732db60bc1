"""Run registered queries in Spark and their SQL in DuckDB, compare the rows."""

import datetime
import decimal
import math

import duckdb

from packetloom.plans.adapters import TABLES
from packetloom.plans.oracle import ORACLES
from packetloom.plans.queries import REGISTRY


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(spark, con, folder, name):
    """Empty text if both sides agree, else what differs first."""
    df = REGISTRY[name](spark, folder)
    got_columns = df.columns
    got = _rows(df.collect(), got_columns)
    cursor = con.execute(ORACLES[name])
    want_columns = [c[0] for c in cursor.description]
    want = _rows(cursor.fetchall(), want_columns)
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} / {sorted(want_columns)}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} / {len(want)}; only Spark {extra}; only SQL {missing}"
    for a, b in zip(got, want):
        kinds = [type(x) is type(y) for x, y in zip(a, b) if x is not None and y is not None]
        if repr(a) != repr(b) or not all(kinds):
            return f"{sum(x != y for x, y in zip(got, want))} rows differ: {a} / {b}"
    return ""
