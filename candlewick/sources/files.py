"""File sources. Schemas are given, so no file is read twice to guess one."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.schemas import BAR, RAW_BAR
from candlewick.sources import folders


CSV = {"header": True, "enforceSchema": False}


def _below(root: str) -> Column:
    """The part of ``path`` below ``root``."""
    bare = re.sub(r"^[a-z0-9]+:/*", "", root).rstrip("/") + "/"
    return F.substr("path", F.locate(bare, F.col("path")) + len(bare))


def read_bars(spark: SparkSession, path: str | Sequence[str], schema: StructType = BAR) -> DataFrame:
    """Bars from CSV files with a header; cells that do not fit the type become null.

    ``schema=RAW_BAR`` reads everything as text, for the type and date checks. A header that does not
    match the schema is an error, not a shift of columns.
    """
    reader = spark.read.schema(schema).options(**CSV, mode="PERMISSIVE")
    return reader.csv(path if isinstance(path, str) else list(path))


def with_source(df: DataFrame) -> DataFrame:
    """Adds the file each row came from, and when that file was changed."""
    return df.withColumns({
        "_source_file": F.col("_metadata.file_path"),
        "_source_modified": F.col("_metadata.file_modification_time"),
    })


def read_prefix(
    spark: SparkSession,
    prefix: str,
    schema: StructType = RAW_BAR,
    with_source_columns: bool = True,
    fmt: str = "csv",
) -> DataFrame:
    """Every file below a prefix as one table, each row tagged with its file."""
    reader = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.options(**CSV)
    df = reader.load(prefix)
    return with_source(df) if with_source_columns else df


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Path, size and change time of every file below ``root``. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(root).select("path", "length", "modificationTime")


def latest_paths(
    spark: SparkSession, root: str, n: int, suffix: str = "", by: str = "file"
) -> list[str]:
    """The ``n`` newest files; ``by='run'`` counts each folder right below ``root`` as one item.

    The listing is a table; only the n chosen paths come back.
    """
    item = F.col("path")
    if by == "run":
        run = F.substring_index(_below(root), "/", 1)
        item = F.concat(F.substr("path", F.lit(1), F.length("path") - F.length(_below(root))), run)
    newest = (
        list_files(spark, root, suffix)
        .groupBy(item.alias("item"))
        .agg(F.max("modificationTime").alias("changed"))
        .orderBy(F.col("changed").desc(), F.col("item").desc())
        .limit(n)
    )
    return [r["item"] for r in newest.collect()]


def latest_files(
    spark: SparkSession,
    root: str,
    n: int,
    suffix: str = ".parquet",
    schema: StructType | None = None,
    fmt: str = "parquet",
    by: str = "file",
) -> DataFrame:
    """Rows of the ``n`` newest files (or runs) below ``root``; no other file is opened."""
    paths = latest_paths(spark, root, n, suffix, by)
    if not paths:
        raise FileNotFoundError(f"no {suffix or 'file'} below {root}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV)
    return with_source(reader.load(paths))


def read_features(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Feature rows of every parquet file below a prefix."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_docs(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """JSON documents: one per file, or one per line with ``multi_line=False`` (files then split)."""
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("recursiveFileLookup", True)
    return reader.json(path if isinstance(path, str) else list(path))


def read_text_docs(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Whole text of every file, with its path and change time."""
    reader = spark.read.option("wholetext", True).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    docs = reader.text(path if isinstance(path, str) else list(path))
    return docs.select(
        F.col("value").alias("content"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_text_heads(
    spark: SparkSession, path: str | Sequence[str], length: int, glob: str | None = None
) -> DataFrame:
    """First ``length`` characters of every file, as (content, source_file, modified).

    Files are read by line and may be split, so a log of any size is fine; at most ``length`` lines
    of each leave the scan. An empty file has an empty text (no scan gives a row for it, so its name
    comes from Spark's listing).
    """
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    start = F.col("_metadata.file_block_start")
    # A character takes up to four bytes: later blocks cannot hold one of the first.
    everything = reader.text(path if isinstance(path, str) else list(path))
    lines = everything.filter(start < 4 * length).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("_size"),
        start.alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.substring("value", 1, length).alias("_head"), F.octet_length("value").alias("_bytes"),
    )
    order = Window.partitionBy("source_file").orderBy("_start", "_row")
    lines = lines.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= length)
    found = lines.groupBy("source_file").agg(
        F.max("modified").alias("modified"),
        F.max("_size").alias("_size"),
        (F.sum("_bytes") + F.count("_bytes") - 1).alias("_read"),
        F.sort_array(F.collect_list(F.struct("_rank", "_head"))).alias("_lines"),
    )
    text = F.array_join(F.transform("_lines", lambda s: s["_head"]), "\n")
    # What the file holds beyond the lines read starts with a line end.
    whole = F.when(F.col("_read") < F.col("_size"), F.concat(text, F.lit("\n"))).otherwise(text)
    return found.select(F.substring(whole, 1, length).alias("content"), "source_file", "modified").unionByName(
        _empty_files(everything)
    )


def _empty_files(files: DataFrame) -> DataFrame:
    """Rows like those of the heads for files that hold nothing.

    The names come from the listing that Spark made on the driver anyway; only those of empty files are
    asked for their time.
    """
    spark = files.sparkSession
    # The listing writes local names with three slashes, the scan with one.
    names = spark.createDataFrame([(re.sub("^file:/+", "file:/", x),) for x in files.inputFiles()], "source_file string")
    filled = files.select(F.col("_metadata.file_path").alias("source_file")).filter(F.col("_metadata.file_block_start") == 0)
    empty = names.join(filled.distinct(), "source_file", "left_anti").collect()
    rows = [("", r["source_file"], folders.modified(spark, r["source_file"])) for r in empty]
    return spark.createDataFrame(rows, "content string, source_file string, _ms long").select(
        "content", "source_file", F.timestamp_millis("_ms").alias("modified")
    )


def file_inventory(spark: SparkSession, root: str, prefixes: Sequence[str] = ()) -> DataFrame:
    """Per prefix (first folder or file name below ``root``): files, size in KB, newest change."""
    files = list_files(spark, root)
    files = files.withColumn("prefix", F.substring_index(_below(root), "/", 1))
    if prefixes:
        files = files.filter(F.col("prefix").isin(list(prefixes)))
    return files.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.sum("length") / 1024, 2).alias("size_kb"),
        F.sum("length").alias("size_bytes"),
        F.max("modificationTime").alias("newest"),
    )
