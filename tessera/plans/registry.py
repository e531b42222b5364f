"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where one exists, an equivalent DuckDB SQL twin over the same tables.

Output conventions for checkable results: every computed column is aliased,
doubles are rounded to 6 places, counts are BIGINT, arrays of ints are joined
into comma-separated strings and float vectors are exploded to long form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.IntegerType) and f.name in ("rank",):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)
