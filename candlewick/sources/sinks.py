"""File sinks and payload builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column


JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_features(
    df: DataFrame, path: str, mode: str = "overwrite", codec: str | None = None, stamp: str | None = None
) -> str:
    """Stores features as parquet, with ``stamp`` in a folder of that run; returns the folder."""
    target = path if stamp is None else f"{path}/{stamp}"
    writer = df.write.mode(mode)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(target)
    return target


def write_per_entity(df: DataFrame, path: str, key: str = "Ticker", mode: str = "overwrite") -> None:
    """CSV files in one folder per entity.

    The rebalance hint brings the rows of an entity together, so that not every task writes a file
    for every entity, and still cuts a hot entity into tasks of the usual size.
    """
    df.hint("rebalance", key).write.mode(mode).partitionBy(key).option("header", True).csv(path)


def append_docs(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per row; times keep their microseconds."""
    df.write.mode(mode).option("timestampFormat", JSON_TIME).json(path)


def to_bulk_ndjson(
    df: DataFrame, index: str, id_col: Column | str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Search-bulk text: an action line, then the document without its null fields.

    The id comes from the row, so a repeated load overwrites instead of duplicating.
    """
    action = F.to_json(F.struct(
        F.struct(F.lit(index).alias("_index"), as_column(id_col).cast("string").alias("_id")).alias("index")
    ))
    doc = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "true"})
    return df.select(F.concat_ws("\n", action, doc).alias("value"))


def to_bulk_documents(
    df: DataFrame, index: str, id_col: Column | str, columns: Sequence[str], fields: str = "fields"
) -> DataFrame:
    """Search-bulk text of whole documents: ``columns``, and every entry of ``fields`` (name to JSON text)."""
    action = F.to_json(F.struct(
        F.struct(F.lit(index).alias("_index"), as_column(id_col).cast("string").alias("_id")).alias("index")
    ))
    own = F.to_json(F.struct(*columns), {"ignoreNullFields": "true", "timestampFormat": JSON_TIME})
    def entry(e: Column) -> Column:
        name = F.to_json(F.array(e["key"]))
        return F.concat(F.substr(name, F.lit(2), F.length(name) - 2), F.lit(":"), e["value"])

    more = F.coalesce(F.array_join(F.transform(F.map_entries(fields), entry), ","), F.lit(""))
    body = F.substr(own, F.lit(2), F.length(own) - 2)
    doc = F.concat(F.lit("{"), F.concat_ws(",", F.nullif(body, F.lit("")), F.nullif(more, F.lit(""))), F.lit("}"))
    return df.select(F.concat_ws("\n", action, doc).alias("value"))


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).text(path)


def _escaped(text: Column) -> Column:
    """Escapes what separates names, tags and fields in the line format."""
    return F.regexp_replace(text, r"([,= ])", r"\\$1")


def _field_text(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "string":
        text = F.concat(F.lit('"'), F.regexp_replace(c, r'(["\\])', r"\\$1"), F.lit('"'))
    elif kind in ("tinyint", "smallint", "int", "bigint"):
        text = F.concat(c.cast("string"), F.lit("i"))
    else:
        text = c.cast("string")
    return F.when(c.isNotNull(), F.concat(_escaped(F.lit(name)), F.lit("="), text))


def to_line_protocol(
    df: DataFrame,
    measurement: Column | str,
    tags: Sequence[str],
    fields: Sequence[str],
    ts: str = "ts",
) -> DataFrame:
    """One ``measurement,tags fields timestamp`` line per row, the time in nanoseconds.

    Null or empty tags and null fields are left out; a row without any field gives no line.
    """
    kinds = dict(df.dtypes)
    name = measurement if isinstance(measurement, Column) else F.lit(measurement)
    tag_parts = []
    for t in tags:
        text = F.nullif(F.col(t).cast("string"), F.lit(""))
        tag_parts.append(F.concat(_escaped(F.lit(t)), F.lit("="), _escaped(text)))
    head = F.concat_ws(",", F.regexp_replace(name, r"([, ])", r"\\$1"), *tag_parts)
    body = F.concat_ws(",", *[_field_text(f, kinds[f]) for f in fields])
    nanos = (F.unix_micros(F.col(ts).cast("timestamp")) * 1000).cast("string")
    lines = df.select(F.concat_ws(" ", head, body, nanos).alias("value"), F.length(body).alias("_len"))
    return lines.filter("_len > 0").select("value")


def to_kafka_value(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as (key, value) with a JSON value, ready for a topic."""
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def write_to_topic(df: DataFrame, options: Mapping[str, str]) -> None:
    """Sends (key, value) rows to a topic; needs the Kafka connector on the class path."""
    df.write.format("kafka").options(**options).save()
