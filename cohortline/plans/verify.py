"""Order-insensitive comparison of Spark results with the DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

from cohortline.sources.tables import DRIVER_TABLES


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    if isinstance(v, (int, decimal.Decimal)) and not isinstance(v, bool):
        return (1, str(int(v)) if v == int(v) else str(v))
    if isinstance(v, dt.datetime):
        return (1, v.isoformat())
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    return (1, str(v))


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


# Spark simple type name -> DuckDB type name, for the types the reports emit.
SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def type_mismatches(spark_dtypes, duck_columns, duck_types) -> dict:
    """Columns whose Spark and DuckDB types differ: {name: (spark, duckdb)}."""
    duck = dict(zip(duck_columns, (str(t) for t in duck_types)))
    return {c: (t, duck.get(c)) for c, t in spark_dtypes
            if SPARK_TO_DUCK.get(t, t) != duck.get(c)}
