"""Connected components of a table of links, by DataFrame operations alone."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import scratch_path

#: Spark's setting that deletes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's limit for the buckets of a table.
_MOST_BUCKETS = 100_000


def _without_shuffle_files(spark: SparkSession, write: Callable[[], None]) -> None:
    """Runs a write whose shuffle files go as soon as it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        write()
    finally:
        spark.conf.set(_CLEANUP, before)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: what was computed survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _without_shuffle_files(spark, lambda: df.write.option("compression", "zstd").parquet(path))
    stored = spark.read.parquet(path)
    stored._stored_at = path
    return stored


def _dealt(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``_stored``, as a table in buckets of ``key``: groups of the key and joins on it need no further shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"candlewick_{os.path.basename(path).replace('-', '_')}"
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    parts = min(int(parts or spark.conf.get("spark.sql.shuffle.partitions")), _MOST_BUCKETS)
    # An insert, as Spark keeps the shuffle files of a query that creates a table.
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (compression 'zstd') "
        f"CLUSTERED BY (`{key}`) INTO {parts} BUCKETS LOCATION '{path}'"
    )
    _without_shuffle_files(spark, lambda: df.write.insertInto(table))
    stored = spark.table(table)
    stored._stored_at, stored._stored_as = path, table
    return stored


def _dropped(stored: DataFrame) -> None:
    """Deletes what ``_stored`` or ``_dealt`` wrote, once nothing reads it any more. Other tables are left alone."""
    table = getattr(stored, "_stored_as", None)
    if table is not None:
        stored.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    path = getattr(stored, "_stored_at", None)
    if path is not None:
        context = stored.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def _unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the links (a, b), both long and not null.

    The component is its smallest node. Large-star and small-star steps alternate until every link
    points at its component; a round costs shuffles of the links, and their number grows with the
    logarithm of the longest path. Minima are combined before the shuffle and the joins can be split,
    so a node of any degree is fine. The driver gets two numbers a round.
    """
    now = _stored(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == mark or state[0] == 0:
            break
        mark = tuple(state)
        now, old = _stored(_small_star(_large_star(now)), "links"), now
        _dropped(old)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
