"""Lag-based forecasting and target estimates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column
from candlewick.operators.series import BARS, Series, newest_rows, running


@dataclass(frozen=True)
class LagModel:
    """Next value = intercept + coefficients · previous values (oldest first)."""

    coefficients: tuple[float, ...]
    intercept: float
    metrics: dict

    @property
    def n(self) -> int:
        return len(self.coefficients)


#: Values of a series that are summarised together, unless the model looks back further.
BLOCK_ROWS = 1024


def _pieces(df: DataFrame, value: str, n: int, fraction: float, series: Series, block_rows: int) -> DataFrame:
    """Stretches of the series: ``part`` ('train' or 'test') and ``v``, the values in order of time.

    The first ``n`` values of a stretch are those before its first label; all others are labels. Stretches of
    one part of a series follow each other, so the last ``n`` values of one are the first of the next, and
    ``first`` and ``last`` mark the outermost ones. A row is stored once, edges twice.
    """
    size = max(block_rows, n + 1)  # so that the first block of a series holds its first label
    number = F.col(value).cast("double")
    known = df.select(*series.key, *series.order, number.alias("_v")).filter(F.abs(number) < float("inf"))
    rows = running(known, position="_pos", series=series, total="_total")
    home = F.floor((F.col("_pos") - 1) / size).cast("long")
    reached = F.when(F.col("_pos") > (home + 1) * size - n, F.array(home, home + 1)).otherwise(F.array(home))
    blocks = (
        rows.select(*series.key, "_pos", "_total", "_v", F.explode(reached).alias("_block"))
        .groupBy(*series.key, "_block")
        .agg(
            F.min("_pos").alias("_from"), F.any_value("_total").alias("_total"),
            F.sort_array(F.collect_list(F.struct("_pos", "_v"))).alias("_rows"),
        )
        .withColumn("_all", F.transform("_rows", lambda r: r["_v"]))
    )
    # Values of the block up to the last training label, if that lies in it or behind it.
    cut = n + F.floor(F.lit(fraction) * (F.col("_total") - n)) - F.col("_from") + 1
    upto = F.greatest(F.lit(0), F.least(cut, F.size("_all"))).cast("int")
    skipped = F.greatest(F.lit(0), upto - n)
    train = F.struct(
        F.lit("train").alias("part"), F.slice("_all", F.lit(1), upto).alias("v"),
        (F.col("_block") == 0).alias("first"), (cut <= F.size("_all")).alias("last"),
    )
    test = F.struct(
        F.lit("test").alias("part"), F.slice("_all", skipped + 1, F.size("_all") - skipped).alias("v"),
        F.lit(False).alias("first"), F.lit(False).alias("last"),
    )
    return blocks.select(F.inline(F.array(train, test))).filter(F.size("v") > n)


def _products(pieces: DataFrame, n: int, shift: float) -> np.ndarray:
    """Sums over all labels of the products of (1, n values before, label), each value less ``shift``.

    One pass: the sum for two places of a window depends on their distance alone, but for the edges of a
    series. So a row takes part in n + 2 products instead of (n + 2)^2 / 2, and the edges of a series in n^2.
    """
    v = F.transform("v", lambda x: x - F.lit(shift))
    train = pieces.filter("part = 'train'").select(v.alias("v"), "first", "last")
    labels = F.size("v") - n

    def times(distance: Column) -> Column:
        both = F.zip_with(F.slice("v", F.lit(1), labels), F.slice("v", distance + 1, labels), lambda x, y: x * y)
        return F.aggregate(both, F.lit(0.0), lambda total, x: total + x)

    plain = F.aggregate(F.slice("v", F.lit(1), labels), F.lit(0.0), lambda total, x: total + x)
    sums = F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(n)), times), F.array(plain, labels.cast("double"))
    )
    ahead = train.select(F.posexplode(sums).alias("i", "x")).groupBy(F.lit(-1).alias("j"), "i").agg(F.sum("x").alias("x"))
    # What enters at the end of a series less what leaves at its start, as a window moves on by one.
    edges = train.select(F.explode(F.array(
        F.struct(F.when(F.col("last"), F.slice("v", labels + 1, F.lit(n))).alias("e"), F.lit(1.0).alias("sign")),
        F.struct(F.when(F.col("first"), F.slice("v", F.lit(1), F.lit(n))).alias("e"), F.lit(-1.0).alias("sign")),
    )).alias("s")).filter("s.e IS NOT NULL").select(F.concat("s.e", F.array(F.lit(1.0))).alias("e"), "s.sign")
    one = edges.select("e", "sign", F.posexplode("e").alias("i", "x"))
    two = one.select("sign", "i", "x", F.posexplode("e").alias("j", "y")).filter("j <= i")
    moved = two.groupBy("j", "i").agg(F.sum(F.col("sign") * F.col("x") * F.col("y")).alias("x"))

    lags, total, change = np.zeros(n + 1), np.zeros(2), np.zeros((n + 1, n + 1))
    # Numbers of the model's own size: (n + 1) (n + 2) / 2 and n + 3.
    for r in ahead.unionByName(moved).collect():
        if r["j"] >= 0:
            change[r["i"], r["j"]] = change[r["j"], r["i"]] = r["x"]
        elif r["i"] <= n:
            lags[r["i"]] = r["x"]
        else:
            total[r["i"] - n - 1] = r["x"]
    out = np.zeros((n + 2, n + 2))
    out[0, 0], out[0, 1], out[1, 1:] = total[1], total[0], lags
    for i in range(1, n + 1):
        out[0, i + 1] = out[0, i] + change[n, i - 1]
        out[i + 1, i + 1 :] = out[i, i : n + 1] + change[i - 1, i - 1 : n]
    return np.triu(out) + np.triu(out, 1).T


def _solved(products: np.ndarray, ridge: float, shift: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept; the penalty acts on values scaled to unit deviation, as Spark ML's does."""
    n = len(products) - 2
    mean = products[0, 1:] / products[0, 0]
    spread = products[1:, 1:] / products[0, 0] - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(spread), 0.0))
    # A value that never changes has no weight; what is left of its spread is rounding.
    varies = deviation > 1e-9 * (np.abs(mean + shift) + np.abs(shift))
    weights, used = np.zeros(n), np.flatnonzero(varies[:n])
    if varies[n] and len(used):
        scaled = spread / np.outer(np.where(varies, deviation, 1.0), np.where(varies, deviation, 1.0))
        system = scaled[np.ix_(used, used)] + ridge / deviation[n] * np.eye(len(used))
        found = np.linalg.lstsq(system, scaled[used, n], rcond=None)[0]
        weights[used] = found * deviation[n] / deviation[used]
    return weights, float(mean[n] + shift - weights @ (mean[:n] + shift))


def train_forecaster(
    df: DataFrame,
    value: str = "Close",
    n: int = 60,
    fraction: float = 0.8,
    series: Series = BARS,
    ridge: float = 0.1,
    block_rows: int = BLOCK_ROWS,
) -> LagModel:
    """Linear model from the ``n`` previous values, fitted on the first part of every series.

    Rows are not widened by their lags: values are kept as stretches of some ``block_rows`` numbers, which are
    stored once for training and test. The normal equations come from sums over them (:func:`_products`), the
    errors from a second look at the test stretches. Values that are missing or not finite are left out first.
    Errors are None where no series has a test row; an error if none has a row to train on.
    """
    if n < 1:
        raise ValueError("a lag model needs at least one lag")
    pieces = _pieces(df, value, n, fraction, series, block_rows).persist()
    try:
        # A value of the usual size: products of distances from it lose no digits.
        shift = pieces.filter("part = 'train'").agg(F.avg(F.element_at("v", n + 1))).first()[0]
        if shift is None:
            raise ValueError(f"no series has a training row with {n} values before it")
        weights, intercept = _solved(_products(pieces, n, shift), ridge, shift)
        model = tuple(float(w) for w in weights)

        def error(i: Column) -> Column:
            return _next_value(F.slice("v", i - n, F.lit(n)), model, intercept) - F.element_at("v", i)

        test = pieces.filter("part = 'test'").select(
            F.transform(F.sequence(F.lit(n + 1), F.size("v")), error).alias("errors")
        )
        square = F.aggregate("errors", F.lit(0.0), lambda total, e: total + e * e)
        size = F.aggregate("errors", F.lit(0.0), lambda total, e: total + F.abs(e))
        rows = F.sum(F.size("errors"))
        metrics = test.agg((F.sum(square) / rows).alias("val_loss"), (F.sum(size) / rows).alias("val_mae"))
        return LagModel(model, intercept, metrics.first().asDict())
    finally:
        pieces.unpersist()


def _next_value(history: Column, coefficients: Sequence[float], intercept: float) -> Column:
    n = len(coefficients)
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    recent = F.slice(history, F.size(history) - n + 1, F.lit(n))
    terms = F.zip_with(recent, weights, lambda x, w: x * w)
    return F.aggregate(terms, F.lit(float(intercept)), lambda total, x: total + x)


def recursive_values(
    history: Column | str, coefficients: Sequence[float], intercept: float, steps: int
) -> Column:
    """Array of ``steps`` forecasts; each one is appended to the history of the next."""
    start = as_column(history)
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        start,
        lambda known, _: F.concat(known, F.array(_next_value(known, coefficients, intercept))),
    )
    return F.slice(grown, F.size(start) + 1, F.lit(steps))


def forecast(
    df: DataFrame,
    coefficients: Sequence[float],
    intercept: float,
    steps: int = 7,
    value: str = "Close",
    series: Series = BARS,
    digits: int = 2,
) -> DataFrame:
    """Per entity with enough rows: one row per forecast step, dated day by day after its last row."""
    n = len(coefficients)
    recent = newest_rows(df.select(*series.key, *series.order, value), n, series)
    # At most n entries per entity, by the rank limit above.
    lagged = recent.groupBy(*series.key).agg(
        F.max(series.time).alias("last_date"),
        F.max_by(value, -F.col("_rank")).alias("latest_close"),
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("_rank")).alias("r"), F.col(value).alias("v")))),
            lambda s: s["v"],
        ).alias("_history"),
    ).filter(F.size("_history") == n)
    values = recursive_values("_history", coefficients, intercept, steps)
    return (
        lagged.select(*series.key, "last_date", "latest_close", F.posexplode(values).alias("_i", "predicted"))
        .select(
            *series.key,
            "latest_close",
            (F.col("_i") + 1).alias("step"),
            F.date_add("last_date", F.col("_i") + 1).alias("day"),
            F.round("predicted", digits).alias("predicted"),
        )
    )


def first_hit(
    forecasts: DataFrame, target: float, value: str = "predicted", key: Sequence[str] = ("Ticker",)
) -> DataFrame:
    """Per entity: first step at or above the target. Step 1 means it is already reached."""
    step = F.min(F.when(F.col(value) >= target, F.col("step")))
    out = forecasts.groupBy(*key).agg(step.alias("first_step"))
    status = (
        F.when(F.col("first_step").isNull(), "not reached")
        .when(F.col("first_step") == 1, "already")
        .otherwise("reached")
    )
    return out.withColumn("status", status)


def days_to_target(
    df: DataFrame,
    target: float,
    value: str = "Close",
    returns: str = "Returns_1d",
    series: Series = BARS,
) -> DataFrame:
    """Per entity: days until the target at the mean daily return; null, with a status, where there is none."""
    out = df.groupBy(*series.key).agg(
        F.max_by(value, series.order_value()).alias("latest_close"), F.avg(returns).alias("mean_return")
    )
    gap = F.lit(float(target)) - F.col("latest_close")
    days = F.floor(F.try_divide(gap, F.col("latest_close") * F.col("mean_return")))
    rising = F.col("mean_return") > 0
    return out.withColumns({
        "gap": gap,
        "days": F.when(rising & (gap > 0), F.greatest(F.lit(1), days)).cast("long"),
        "status": F.when(gap <= 0, "reached").when(rising, "rising").otherwise("not rising"),
    })
