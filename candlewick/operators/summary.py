"""Aggregations. Each combines on the map side, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column, ratio
from candlewick.operators.series import BARS, Series, newest_rows


def cluster_summary(
    df: DataFrame, key: str = "Cluster", columns: Sequence[str] = ("Close", "Volume", "Returns_1d")
) -> DataFrame:
    """Mean of each column per cluster; rows without a cluster are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column))


def pct_positive(df: DataFrame, key: str = "Cluster", column: str = "Returns_1d") -> DataFrame:
    """Per group: rows, and the percentage with a value above zero (a null value counts as not above)."""
    up = F.when(F.col(column) > 0, 1.0).otherwise(0.0)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), (F.avg(up) * 100).alias("pct_up"))
    )


def latest_per_key(
    df: DataFrame,
    key: str = "Ticker",
    ts: str = "Date",
    columns: Sequence[str] = ("Open", "High", "Low", "Close", "Volume"),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Last non-null value of every column per entity, with the change from Open to Close.

    Rows of one time are told apart by the ``ties`` columns, largest last; without them any may win.
    """
    last = F.struct(ts, *ties) if ties else F.col(ts)
    newest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), last)).alias(c) for c in columns]
    out = df.groupBy(key).agg(F.max(ts).alias(ts), *newest)
    if "Open" in columns and "Close" in columns:
        change = F.col("Close") - F.col("Open")
        out = out.withColumns({"Change": change, "Change_Pct": ratio(change, "Open") * 100})
    return out


def describe_series(df: DataFrame, key: str = "Ticker", ts: str = "Date") -> DataFrame:
    """One row per entity: rows, first and last time."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )


def describe_overall(df: DataFrame, key: str = "Ticker", ts: str = "Date") -> DataFrame:
    """One row: entities, rows, first and last time. Counts per entity first, so no wide distinct."""
    return describe_series(df, key, ts).agg(
        F.count(key).alias("n_symbols"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def overall_extrema(df: DataFrame, value: str = "Close", key: str = "Ticker", ts: str = "Date") -> DataFrame:
    """Per entity: newest and highest value."""
    return df.groupBy(key).agg(
        F.max_by(F.col(value), F.col(ts)).alias("latest_close"), F.max(value).alias("max_close")
    )


def mean_return(df: DataFrame, value: str = "Returns_1d", key: str = "Ticker") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("mean_return"))


def severity_counts(logs: DataFrame, by: Sequence[str] = ("severity",)) -> DataFrame:
    return logs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def metric_sum(
    points: DataFrame, measurement: str, labels: Mapping[str, str], value: str = "value"
) -> DataFrame:
    """Sum of a metric over the points that carry all the given labels."""
    rows = points.filter(F.col("measurement") == measurement)
    for label, wanted in labels.items():
        rows = rows.filter(F.try_element_at(F.col("tags"), F.lit(label)) == wanted)
    return rows.agg(F.sum(value).alias("total"))


def last_point(
    points: DataFrame,
    ts: Column | str = "ts",
    by: Sequence[str] = ("measurement", "field"),
    order: Column | None = None,
) -> DataFrame:
    """Newest point per series. Give an ``order`` that is unique in a series: of equal ones any may win."""
    rank = order if order is not None else as_column(ts)
    return points.groupBy(*by).agg(
        F.max_by(F.col("value"), rank).alias("value"), F.max(ts).alias("ts")
    )


def pivot_metrics(
    points: DataFrame, fields: Sequence[str], row_key: Sequence[str] = ("ts",), *, order: str
) -> DataFrame:
    """Long to wide: one row per row key, one column per field.

    The fields are given, so no extra job has to find them. Of several values in a cell, the one with
    the largest ``order`` is taken.
    """
    chosen = F.max_by("value", order)
    return points.groupBy(*row_key).pivot("field", list(fields)).agg(chosen)


def group_alerts(alerts: DataFrame, keys: Sequence[str] = ("alertname", "job"), ts: str = "ts") -> DataFrame:
    return alerts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_alerts"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at")
    )


def sort_series(df: DataFrame, series: Series = BARS) -> DataFrame:
    """Range-partitioned sort for presentation; windows sort for themselves."""
    return df.orderBy(*series.key, *series.order)


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def tail_n(df: DataFrame, n: int, series: Series = BARS) -> DataFrame:
    """The last n rows of every series, with ``position`` 1 = newest."""
    return newest_rows(df, n, series, "position")


def newest(df: DataFrame, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest document."""
    return df.orderBy(*[F.col(c).desc() for c in (ts, *tie)]).limit(1)
