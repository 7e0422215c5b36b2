"""Spark-vs-DuckDB comparison used by the tests (row count, column names, values).

Values are compared order-insensitively after sorting columns by name;
doubles are compared after rounding to 6 decimals.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from aerolith.sources.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        v = round(v, 6) + 0.0
        return int(v) if v.is_integer() and abs(v) < 2**53 else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return _norm_value(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm_value(v.asDict())
    return v


def _scalar(x):
    if hasattr(x, "item") and getattr(x, "ndim", 0) == 0:
        return x.item()
    try:
        if pd.isna(x):
            return None
    except (TypeError, ValueError):
        pass
    return x


def normalise(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm_value(_scalar(x)) for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    spdf = spark_df.toPandas()
    if sorted(spdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: spark={sorted(spdf.columns)} duck={sorted(duck_pdf.columns)}"
    if len(spdf) != len(duck_pdf):
        return False, f"row count spark={len(spdf)} duck={len(duck_pdf)}"
    a, b = normalise(spdf), normalise(duck_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"first differing row {i}:\n spark={x}\n duck ={y}"
    return True, f"{len(a)} rows match"
