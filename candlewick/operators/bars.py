"""Open/high/low/close/volume bars from raw points, and per-row bar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column, ratio

DATE_GRAINS = ("day", "week", "month", "quarter", "year")


def build_bars(
    df: DataFrame,
    key: Column | str,
    ts: Column | str,
    price: Column | str,
    order: Column | str,
    grain: str = "day",
) -> DataFrame:
    """One bar per entity and period. ``order`` says which point opens and which closes the bar.

    Give ``order`` a fixed-width value (a number, a time, ``packed_order``): the four prices then
    come out of one hash aggregation with a map-side combine, so a hot entity shuffles one row per
    task and period.
    """
    time = as_column(ts)
    if grain == "day":
        period = time.cast("date")
    elif grain in DATE_GRAINS:
        period = F.trunc(time.cast("date"), grain)
    else:
        period = F.date_trunc(grain, time).cast("timestamp_ntz")
    points = df.select(
        as_column(key).alias("Ticker"),
        period.alias("Date"),
        as_column(price).cast("double").alias("_price"),
        as_column(order).alias("_order"),
    )
    return points.groupBy("Ticker", "Date").agg(
        F.min_by("_price", "_order").alias("Open"),
        F.max("_price").alias("High"),
        F.min("_price").alias("Low"),
        F.max_by("_price", "_order").alias("Close"),
        F.count(F.lit(1)).alias("Volume"),
    )


def with_daily_change(df: DataFrame, round_to: int | None = None) -> DataFrame:
    """Close - Open, absolute and in percent of Open."""
    change = F.col("Close") - F.col("Open")
    percent = ratio(change, "Open") * 100
    if round_to is not None:
        change, percent = F.round(change, round_to), F.round(percent, round_to)
    return df.withColumns({"Daily_Change": change, "Daily_Change_Pct": percent})


def with_price_range(df: DataFrame) -> DataFrame:
    return df.withColumn("Price_Range", F.col("High") - F.col("Low"))


def with_intraday_volatility(df: DataFrame) -> DataFrame:
    return df.withColumn("Volatility", ratio(F.col("High") - F.col("Low"), "Open"))


def with_range_ratios(df: DataFrame) -> DataFrame:
    """Range against Open, Close against Open, High against Low; null over zero."""
    return df.withColumns({
        "Price_Range_Pct": ratio(F.col("High") - F.col("Low"), "Open"),
        "Close_Open_Ratio": ratio("Close", "Open"),
        "High_Low_Ratio": ratio("High", "Low"),
    })
