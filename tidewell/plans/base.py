"""The table of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.adapters import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(text: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL that gives the same rows."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = sql(text)
        return f

    return put


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})
