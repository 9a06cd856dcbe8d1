"""Operators that bring two sides together.

No join carries a hint: Spark broadcasts a side only after its size is known, and splits skewed
partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import symbol_name


def with_group_means(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Adds to each row the means of its group: ``columns`` maps source column to new column.

    Every key is a group, whatever its value; rows with a null key get null. The means are joined
    without a hint: Spark broadcasts them if it measures that they are small.
    """
    means = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_group")).agg(
        *[F.avg(source).alias(target) for source, target in columns.items()]
    )
    return df.join(means, F.col(key) == F.col("_group"), "left").drop("_group")


def enrich_with_cluster_means(df: DataFrame) -> DataFrame:
    """Mean Close and Volatility_5d of each row's cluster, and the distance of Close from it."""
    wanted = {"Close": "Cluster_Avg_Close", "Volatility_5d": "Cluster_Avg_Volatility"}
    rows = with_group_means(df, "Cluster", wanted)
    return rows.withColumn("Price_vs_Cluster", F.col("Close") - F.col("Cluster_Avg_Close"))


def with_symbol_name(
    df: DataFrame, names: Mapping[str, str] | DataFrame, column: str = "Ticker", target: str = "Nama_Saham"
) -> DataFrame:
    """Adds the name of each symbol; null for an unknown one.

    A dictionary becomes a literal map (no join). A table with columns (column, target) is joined; of
    several names for one symbol the first in sort order is taken.
    """
    if isinstance(names, DataFrame):
        one_each = names.groupBy(column).agg(F.min(target).alias(target))
        return df.join(one_each, column, "left")
    return df.withColumn(target, symbol_name(column, names))


def inhibit(
    alerts: DataFrame,
    source: str = "critical",
    target: str = "warning",
    equal: Sequence[str] = ("alertname", "job"),
) -> DataFrame:
    """Drops ``target`` alerts while a ``source`` alert with the same labels is firing.

    ``alerts`` holds firing alerts only; every other row passes, and only target rows are shuffled.
    """
    suppressing = (
        alerts.filter(F.col("severity") == source)
        .select(*[F.col(c).alias(f"_s_{c}") for c in equal])
        .distinct()
    )
    same = F.lit(True)
    for c in equal:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    is_target = F.col("severity").eqNullSafe(F.lit(target))
    return alerts.filter(is_target).join(suppressing, same, "left_anti").unionByName(alerts.filter(~is_target))
