"""Row filters. Comparisons of plain columns reach the file scan; those of computed symbols do not."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from candlewick.functions.scalar import finite, normalize_symbol


def filter_symbol(df: DataFrame, pattern: str, column: str = "Ticker") -> DataFrame:
    """Rows whose canonical symbol contains the canonical pattern; null symbols never match.

    The symbol is computed per row, so every row is read. ``filter_whole_symbol`` is pushed down.
    """
    bare = pattern.replace(".JK", "").replace("^", "")
    return df.filter(normalize_symbol(column).contains(bare))


def filter_whole_symbol(df: DataFrame, symbol: str, column: str = "Ticker") -> DataFrame:
    """Rows of one symbol in any of its stored spellings: an IN list that the file scan evaluates."""
    bare = symbol.replace(".JK", "").replace("^", "")
    return df.filter(F.col(column).isin(bare, f"{bare}.JK", f"^{bare}"))


def filter_symbols(df: DataFrame, symbols: Iterable[str] | DataFrame, column: str = "Ticker") -> DataFrame:
    """Rows of a chosen set: an IN list for a few values, a semi join for a table of them."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(column).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(symbols)))


def clean_infinite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities to null in the floating-point columns."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    chosen = [c for c in floats if columns is None or c in columns]
    return df.withColumns({c: finite(c) for c in chosen})


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Cleans NaN and infinities, then drops the rows with a null in ``subset``."""
    return clean_infinite(df).na.drop(subset=list(subset))


def since(df: DataFrame, ts: str, interval: str, now: Column | None = None) -> DataFrame:
    """Rows of the last ``interval`` up to ``now``; ``now`` defaults to the newest time in the data.

    The default is a scalar subquery: one extra pass over the time column, no join.
    """
    newest = now if now is not None else df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.expr(f"INTERVAL {interval}"))


def metric(df: DataFrame, measurement: str, field: str | None = None) -> DataFrame:
    """Points of one measurement (and field) of a long-format metric table."""
    rows = df.filter(F.col("measurement") == measurement)
    return rows if field is None else rows.filter(F.col("field") == field)
