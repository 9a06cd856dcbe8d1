"""SQL access to the tables of a folder, and tables that are stored by entity."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DateType, FloatType, IntegerType, ShortType, StringType


def register_tables(
    spark: SparkSession, folder: str, names: Sequence[str], prefix: str = "", suffix: str = ".parquet"
) -> list[str]:
    """Makes ``folder/name.parquet`` queryable as a temporary view; returns the view names."""
    views = []
    for name in names:
        view = f"{prefix}{name}"
        spark.read.parquet(f"{folder}/{name}{suffix}").createOrReplaceTempView(view)
        views.append(view)
    return views


_WIDTHS = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row before encoding: fixed widths, lengths of texts, and JSON lengths of nested values."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + _WIDTHS.get(type(f.dataType), 8)
    return total


@dataclass(frozen=True)
class Layout:
    """How a table was stored: buckets of the table itself, and of ``hot`` if some entities were too large."""

    buckets: int
    hot: str | None = None
    hot_buckets: int = 0


def save_bucketed(
    df: DataFrame, table: str, path: str, key: Sequence[str] = ("Ticker",), file_bytes: int = 512 << 20
) -> Layout:
    """Stores a table bucketed by its entity, so that later windows and joins on it need no shuffle.

    Sizes are measured: one aggregation by entity, of which two sums reach the driver. The number of
    buckets is that of files of ``file_bytes`` (before encoding). Entities larger than a file go to a second
    table, ``<table>_hot``, bucketed by entity and a salt with as many values as the entity has files: group-bys
    combine inside (entity, salt) without a shuffle, and series take a split. Rows are hashed to their
    bucket first: one file per bucket instead of one per task and bucket.
    """
    sizes = df.groupBy(*key).agg(F.sum(row_bytes(df)).alias("_bytes"))
    large = sizes.filter(F.col("_bytes") > file_bytes).withColumn("_salts", F.ceil(F.col("_bytes") / file_bytes).cast("int"))
    fits = F.col("_bytes") <= file_bytes
    found = sizes.agg(
        F.sum(F.when(fits, F.col("_bytes"))).alias("cold"), F.sum(F.when(~fits, F.ceil(F.col("_bytes") / file_bytes))).alias("hot")
    ).first()
    layout = Layout(max(1, math.ceil((found["cold"] or 0) / file_bytes)), f"{table}_hot" if found["hot"] else None, int(found["hot"] or 0))

    def store(rows: DataFrame, name: str, folder: str, by: Sequence[str], buckets: int) -> None:
        hashed = rows.repartition(buckets, *by)
        hashed.write.mode("overwrite").bucketBy(buckets, *by).option("path", folder).saveAsTable(name)

    if layout.hot is None:
        store(df, table, path, key, layout.buckets)
        return layout
    names = {k: f"_l_{k}" for k in key}
    marks = large.drop("_bytes").withColumnsRenamed(names)
    same = F.lit(True)
    for k, other in names.items():
        same = same & F.col(k).eqNullSafe(F.col(other))
    store(df.join(marks, same, "left_anti"), table, path, key, layout.buckets)
    salted = df.join(marks, same).withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.col("_salts")).cast("int"))
    store(salted.select(*df.columns, "_salt"), layout.hot, f"{path}_hot", [*key, "_salt"], layout.hot_buckets)
    return layout
