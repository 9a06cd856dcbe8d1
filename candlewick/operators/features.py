"""Feature frames over bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions import windows as wf
from candlewick.operators.bars import with_intraday_volatility, with_price_range, with_range_ratios
from candlewick.operators.filters import drop_incomplete
from candlewick.operators.series import BARS, Series, in_blocks

REQUIRED = ("Open", "High", "Low", "Close", "Volume")

# Deepest chain of frames of each feature set, in rows.
ETL_REACH = 30
ML_REACH = 20


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def etl_features(df: DataFrame, series: Series = BARS) -> DataFrame:
    """Bars plus SMA_7, SMA_30 (partial at the start), Volatility and Price_Range."""
    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({"SMA_7": wf.sma("Close", 7, w), "SMA_30": wf.sma("Close", 30, w)})

    require_columns(df, [*series.key, *series.order, *REQUIRED])
    out = in_blocks(df, series, compute, before=ETL_REACH)
    return with_price_range(with_intraday_volatility(out))


def ml_features(
    df: DataFrame, series: Series = BARS, keep_incomplete: bool = False
) -> DataFrame:
    """Bars plus returns, averages, volatility, RSI, lags and targets.

    One window specification carries all of it, so a stored bar table is shuffled and sorted once.
    Rows without Returns_1d or Volatility_5d are dropped unless ``keep_incomplete``.
    """
    require_columns(df, [*series.key, *series.order, *REQUIRED])
    fill = {"_close": F.col("Close"), "_volume": F.col("Volume")}

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rows.withColumns({
            "Returns_1d": wf.change_over("_close", 1, w),
            "Returns_5d": wf.change_over("_close", 5, w),
            "SMA_5": wf.sma("Close", 5, w, min_periods=5),
            "SMA_20": wf.sma("Close", 20, w, min_periods=20),
            "Volume_Change": wf.change_over("_volume", 1, w),
            "Lag_1_Close": F.lag("Close", 1).over(w),
            "Lag_2_Close": F.lag("Close", 2).over(w),
            "Lag_3_Close": F.lag("Close", 3).over(w),
            "_step": wf.delta("Close", w),
            "Target_Up": wf.target_up("Close", w),
            "Target_Change": wf.target_change("Close", w),
        })
        return rows.withColumns({
            "Volatility_5d": wf.rolling_std("Returns_1d", 5, w),
            "RSI": wf.rsi("_step", 14, w),
        })

    rows = in_blocks(df, series, compute, before=ML_REACH, after=1, fill=fill)
    rows = with_range_ratios(with_price_range(rows))
    rows = rows.withColumn("SMA_Cross", F.col("SMA_5") - F.col("SMA_20"))
    rows = rows.drop("_close", "_volume", "_step")
    return rows if keep_incomplete else drop_incomplete(rows, ["Returns_1d", "Volatility_5d"])


def sma(
    df: DataFrame,
    column: str,
    k: int,
    min_periods: int = 1,
    series: Series = BARS,
    name: str | None = None,
) -> DataFrame:
    """Moving average; ``min_periods=k`` leaves the first k-1 rows null."""
    target = name or f"SMA_{k}"
    return in_blocks(
        df, series, lambda rows, w: rows.withColumn(target, wf.sma(column, k, w, min_periods)), k
    )


def pct_change(
    df: DataFrame,
    column: str,
    n: int = 1,
    scale: float = 1.0,
    series: Series = BARS,
    name: str | None = None,
) -> DataFrame:
    """Relative change against n rows ago, gaps filled forward first; ``scale=100`` for percent."""
    target = name or f"{column}_change_{n}"
    return in_blocks(
        df,
        series,
        lambda rows, w: rows.withColumn(target, wf.change_over("_filled", n, w) * scale),
        n,
        fill={"_filled": F.col(column)},
    ).drop("_filled")


def rolling_std(
    df: DataFrame,
    column: str,
    k: int,
    series: Series = BARS,
    name: str | None = None,
) -> DataFrame:
    target = name or f"{column}_std_{k}"
    return in_blocks(
        df, series, lambda rows, w: rows.withColumn(target, wf.rolling_std(column, k, w)), k
    )


def lags(
    df: DataFrame,
    column: str,
    steps: Sequence[int],
    series: Series = BARS,
) -> DataFrame:
    return in_blocks(
        df,
        series,
        lambda rows, w: rows.withColumns({f"Lag_{n}_{column}": F.lag(column, n).over(w) for n in steps}),
        max(steps),
    )


def sma_cross(
    df: DataFrame,
    fast: int = 5,
    slow: int = 20,
    column: str = "Close",
    series: Series = BARS,
) -> DataFrame:
    """Fast minus slow average, and ``Cross_Signal``: 1 / -1 where the sign turns up / down, else 0."""
    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        gap = wf.sma(column, fast, w, fast) - wf.sma(column, slow, w, slow)
        rows = rows.withColumn("SMA_Cross", gap)
        now, earlier = F.signum("SMA_Cross"), F.signum(F.lag("SMA_Cross", 1).over(w))
        turned = F.when(now != earlier, now.cast("int")).otherwise(F.lit(0))
        return rows.withColumn("Cross_Signal", turned)

    return in_blocks(df, series, compute, slow + 1)


def rsi(
    df: DataFrame,
    column: str = "Close",
    period: int = 14,
    series: Series = BARS,
) -> DataFrame:
    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rows.withColumn("_step", wf.delta(column, w))
        return rows.withColumn("RSI", wf.rsi("_step", period, w)).drop("_step")

    return in_blocks(df, series, compute, period)


def targets(
    df: DataFrame, column: str = "Close", series: Series = BARS
) -> DataFrame:
    """Target_Up and Target_Change: what the next row does."""
    return in_blocks(
        df,
        series,
        lambda rows, w: rows.withColumns(
            {"Target_Up": wf.target_up(column, w), "Target_Change": wf.target_change(column, w)}
        ),
        before=0,
        after=1,
    )
