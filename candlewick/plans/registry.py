"""Where queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``, with the SQL that must give the same rows."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles})
