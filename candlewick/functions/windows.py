"""Expressions over an ordered window of one series.

``w`` is a window with partition and order but no frame; every function adds its own ROWS frame, so
all of them share one shuffle and one sort. Minimum periods count non-null values.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column, ratio


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(1 - rows, Window.currentRow)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def sma(value: Column | str, k: int, w: WindowSpec, min_periods: int = 1) -> Column:
    """Mean of the last ``k`` rows, null until ``min_periods`` of them hold a value."""
    c = as_column(value)
    mean = F.avg(c).over(trailing(w, k))
    if min_periods <= 1:
        return mean
    return F.when(F.count(c).over(trailing(w, k)) >= min_periods, mean)


def rolling_std(value: Column | str, k: int, w: WindowSpec) -> Column:
    """Sample standard deviation of the last ``k`` rows, all of them required."""
    c = as_column(value)
    return F.when(F.count(c).over(trailing(w, k)) >= k, F.stddev_samp(c).over(trailing(w, k)))


def ffill(value: Column | str, w: WindowSpec) -> Column:
    """Last value seen so far that is not null."""
    return F.last(as_column(value), ignorenulls=True).over(running(w))


def change_over(filled: Column | str, n: int, w: WindowSpec) -> Column:
    """Relative change against ``n`` rows ago, of a column that is already filled forward."""
    c = as_column(filled)
    return ratio(c, F.lag(c, n).over(w)) - 1


def delta(value: Column | str, w: WindowSpec) -> Column:
    c = as_column(value)
    return c - F.lag(c, 1).over(w)


def mean_gain(step: Column | str, period: int, w: WindowSpec) -> Column:
    """Mean rise over ``period`` rows; a missing step counts as no rise."""
    c = as_column(step)
    return F.avg(F.when(c > 0, c).otherwise(F.lit(0.0))).over(trailing(w, period))


def mean_loss(step: Column | str, period: int, w: WindowSpec) -> Column:
    c = as_column(step)
    return F.avg(F.when(c < 0, -c).otherwise(F.lit(0.0))).over(trailing(w, period))


def rsi(step: Column | str, period: int, w: WindowSpec) -> Column:
    """Simple-mean RSI of the row-to-row steps; null before ``period`` rows and without any loss."""
    full = F.count(F.lit(1)).over(trailing(w, period)) == period
    strength = ratio(mean_gain(step, period, w), mean_loss(step, period, w))
    return F.when(full, 100 - 100 / (1 + strength))


def target_up(value: Column | str, w: WindowSpec) -> Column:
    """1 when the next row is higher, else 0; 0 on the last row."""
    c = as_column(value)
    return F.coalesce((F.lead(c, 1).over(w) > c).cast("int"), F.lit(0))


def target_change(value: Column | str, w: WindowSpec) -> Column:
    c = as_column(value)
    return F.lead(c, 1).over(w) - c
