"""The registered queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable_by_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, unless it is shipped
    (``--py-files``) or a path was set already."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(run)
        def ready(spark: SparkSession, folder: str) -> DataFrame:
            reachable_by_workers(spark)
            return run(spark, folder)

        QUERIES[name] = ready
        if sql is not None:
            ORACLES[name] = sql
        return ready

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
