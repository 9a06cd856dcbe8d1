"""Scalar column expressions. All of them stay inside generated code; none raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

INFINITY = float("inf")


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom``; null where the denominator is zero."""
    return F.try_divide(as_column(top), as_column(bottom))


def finite(value: Column | str) -> Column:
    """Null in place of NaN and both infinities."""
    c = as_column(value)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(INFINITY)), None).otherwise(c)


def normalize_symbol(symbol: Column | str) -> Column:
    """One canonical form: no ``.JK`` suffix, no ``^`` index prefix."""
    return F.replace(F.replace(as_column(symbol), F.lit(".JK"), F.lit("")), F.lit("^"), F.lit(""))


def symbol_name(symbol: Column | str, names: Mapping[str, str]) -> Column:
    """Name of a symbol from a fixed dictionary, as a literal map (no join)."""
    table = F.create_map(*[F.lit(part) for item in names.items() for part in item])
    return F.try_element_at(table, as_column(symbol))


def parse_date(text: Column | str, fmt: str | None = None) -> Column:
    """Text to DATE; null where it cannot be read."""
    c = as_column(text)
    return c.try_cast("date") if fmt is None else F.try_to_date(c, fmt)


def parse_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    """ISO text to TIMESTAMP; null where it cannot be read."""
    c = as_column(text)
    return F.try_to_timestamp(c) if fmt is None else F.try_to_timestamp(c, F.lit(fmt))


def parse_dates(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    return df.withColumn(column, parse_date(column, fmt))


def round_cols(df: DataFrame, columns: Iterable[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def first_non_empty(*values: Column | str, default: Column | str | None = None) -> Column:
    """First value that is neither null nor the empty string; ``default`` is a literal or a column."""
    options = [F.nullif(as_column(v), F.lit("")) for v in values]
    if default is not None:
        options.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*options)


def classify(text: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first substring, in rule order, that ``text`` contains."""
    c = as_column(text)
    chain = F
    for part, label in rules:
        chain = chain.when(c.contains(part), F.lit(label))
    return chain.otherwise(F.lit(default))


def truncate(text: Column | str, length: int) -> Column:
    return F.substring(as_column(text), 1, length)


def floor_clip(value: Column | str, default: float, lowest: float) -> Column:
    """``default`` for a missing value, never below ``lowest``."""
    return F.greatest(F.coalesce(as_column(value), F.lit(default)), F.lit(lowest))


def bands(
    value: Column | str,
    steps: Iterable[tuple[float, str]],
    below: str,
    inclusive: bool = True,
) -> Column:
    """Label of the highest threshold reached; ``below`` under all of them, null for null.

    Steps may come in any order.
    """
    c = as_column(value)
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for threshold, label in sorted(steps, reverse=True):
        reached = c >= threshold if inclusive else c > threshold
        chain = chain.when(reached, F.lit(label))
    return chain.otherwise(F.lit(below))


def rsi_label(rsi: Column | str, high: float = 70, low: float = 30) -> Column:
    """Strictly above ``high`` is overbought, strictly below ``low`` is oversold."""
    c = as_column(rsi)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c > high, F.lit("overbought"))
        .when(c < low, F.lit("oversold"))
        .otherwise(F.lit("neutral"))
    )


def as_json(df: DataFrame, name: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON object per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


def parse_json(text: Column | str, schema: StructType | str) -> Column:
    return F.from_json(as_column(text), schema)


def predictions_map(start: Column | str, values: Column | str, digits: int = 2) -> Column:
    """Array of forecasts to a map from ``yyyy-MM-dd`` (day after ``start`` first) to rounded value."""
    v = as_column(values)
    days = F.transform(
        F.sequence(F.lit(1), F.size(v)),
        lambda i: F.date_format(F.date_add(as_column(start), i), "yyyy-MM-dd"),
    )
    return F.map_from_arrays(days, F.transform(v, lambda x: F.round(x, digits)))


def explode_predictions(df: DataFrame, map_column: str = "predictions") -> DataFrame:
    """One row per (date, value) entry of the forecast map; the other columns are kept."""
    rest = [c for c in df.columns if c != map_column]
    return df.select(*rest, F.explode(map_column).alias("day", "value")).withColumn(
        "day", F.col("day").try_cast("date")
    )


def packed_order(time: Column | str, tie: Column | str) -> Column:
    """(time, tie) as one decimal that sorts like the pair.

    A single fixed-width ordering value keeps ``min_by`` / ``max_by`` in hash aggregation; a struct
    would force a sort before the map-side combine. ``tie`` is a non-negative integer below 10^18.
    """
    micros = F.unix_micros(as_column(time).cast("timestamp")).cast("decimal(20,0)")
    scaled = (micros * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)")
    return (scaled + as_column(tie).cast("decimal(18,0)")).cast("decimal(38,0)")
