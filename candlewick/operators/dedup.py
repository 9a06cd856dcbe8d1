"""Union and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_frames(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing from one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_newest(
    df: DataFrame,
    keys: Sequence[str] = ("Ticker", "Date"),
    recency: str = "_source_modified",
    tie: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one from the newest file, ties broken by ``tie`` (largest wins).

    Spark applies the rank limit before the shuffle too, so each task sends at most one row per key
    however many copies there are.
    """
    order = [F.col(c).desc_nulls_last() for c in (recency, *tie)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def duplicate_count(df: DataFrame, exclude: Sequence[str] = ("_source_file",)) -> DataFrame:
    """One row: how many rows repeat an earlier one in every column (nulls equal)."""
    columns = [c for c in df.columns if c not in exclude]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))
