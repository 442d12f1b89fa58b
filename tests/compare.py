"""Run queries and their SQL twins side by side."""

from __future__ import annotations

import datetime
import decimal
import math
import time
from collections import Counter

import duckdb

from marketlake.verification import ORACLES, QUERIES
from marketlake.verification.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """One spelling per value: numbers by value, dates as text."""
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value.is_integer() else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    seconds = time.time() - start
    result = {"name": name, "rows": len(rows), "seconds": round(seconds, 2), "ok": True, "note": ""}
    if name not in ORACLES:
        result["note"] = "rows only"
        result["ok"] = len(rows) > 0
        return result
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return result | {"ok": False, "note": f"columns {sorted(df.columns)} != {sorted(columns)}"}
    ours, theirs = rows_of(df.columns, rows), rows_of(columns, expected)
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        result |= {"ok": False, "note": f"{len(extra)} extra, {len(missing)} missing of {len(expected)}; {sorted(columns)}; extra {extra[:2]}; missing {missing[:2]}"}
    elif not rows:
        result["note"] = "no rows on either side"
    return result
