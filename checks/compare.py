"""Plain result types for comparisons, and a row-by-row comparison of Spark with DuckDB."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import BASE_TABLES


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as text, timestamps without a zone, all integers as long."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same bag of rows under the same column names."""
    result = con.execute(sql)
    names = sorted(d[0] for d in result.description)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    order = [[d[0] for d in result.description].index(n) for n in names]
    theirs = sorted((_row([r[i] for i in order]) for r in result.fetchall()), key=repr)
    ours = sorted((_row([r[n] for n in names]) for r in df.collect()), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if not bad:
        return None
    columns = [n for n, x, y in zip(names, *bad[0]) if x != y]
    return f"{len(bad)} of {len(ours)} rows differ, first in {columns}: {bad[0]}"


def _row(values: list) -> tuple:
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in values)
