"""Source and sink queries: data goes out through a sink and comes back through a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators.bars import with_daily_change
from candlewick.operators.features import etl_features
from candlewick.operators.joins import with_symbol_name
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded
from candlewick.plans.windows import etl_sql
from candlewick.schemas import BAR, RAW_BAR
from candlewick.session import scratch_path
from candlewick.sources import files, sinks
from candlewick.sources.catalog import register_tables

_NAMED = """
    SELECT "Date", "Ticker", CASE "Ticker" WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
           WHEN '3-MEDIUM' THEN 'Medium' END AS "Nama_Saham", "Open", "High", "Low", "Close", "Volume",
           round("Close" - "Open", 2) AS "Daily_Change",
           round(("Close" - "Open") / nullif("Open", 0) * 100, 2) AS "Daily_Change_Pct" FROM bars"""


def _named(spark, sf):
    df = with_daily_change(with_symbol_name(fx.bars(spark, sf), fx.NAMES), round_to=2)
    return df.select(*BAR.fieldNames())


@query("scan_bars_csv", with_tables("bars", body=_NAMED))
def scan_bars_csv(spark, sf):
    path = scratch_path(spark, "bars-csv")
    _named(spark, sf).write.option("header", True).csv(path)
    return files.read_bars(spark, path)


@query("scan_multi_with_source", with_tables("bars", body="""
    SELECT CAST(year("Date") AS INTEGER) AS year, CAST("Date" AS VARCHAR) AS "Date", "Ticker", CAST("Volume" AS VARCHAR) AS "Volume"
    FROM bars"""))
def scan_multi_with_source(spark, sf):
    path = scratch_path(spark, "bars-by-year")
    tagged = _named(spark, sf).withColumn("year", F.year("Date"))
    tagged.write.partitionBy("year").option("header", True).csv(path)
    df = files.read_prefix(spark, path, RAW_BAR)
    year = F.regexp_extract("_source_file", r"year=(\d+)", 1).cast("int")
    return df.select(year.alias("year"), "Date", "Ticker", "Volume")


@query("scan_latest_n_files", with_tables("bars", body="""
    SELECT "Ticker", "Date", "Close" FROM bars WHERE year("Date") >= 1998"""))
def scan_latest_n_files(spark, sf):
    """Three runs write one after the other; the newest two are read."""
    path = scratch_path(spark, "stamped-runs")
    year = F.year("Date")
    bars = fx.bars(spark, sf).select("Ticker", "Date", "Close")
    ages = {"a": year < 1998, "b": year.between(1998, 1999), "c": year >= 2000}
    for run, rows in ages.items():
        sinks.write_features(bars.filter(rows), path, stamp=run)
    return files.latest_files(spark, path, 2, by="run").select("Ticker", "Date", "Close")


@query("scan_parquet", with_tables("bars", body=etl_sql("bars")))
def scan_parquet(spark, sf):
    path = scratch_path(spark, "features")
    sinks.write_features(rounded(etl_features(fx.bars(spark, sf))), path)
    return files.read_features(spark, path)


@query("scan_json_docs", with_tables("bars", body=_NAMED))
def scan_json_docs(spark, sf):
    path = scratch_path(spark, "docs")
    sinks.append_docs(_named(spark, sf), path)
    return files.read_docs(spark, path, BAR, multi_line=False)


@query("file_inventory", """
    SELECT 'event_type=' || event_type AS prefix, CAST(1 AS BIGINT) AS n_files, CAST(sum(strlen(props) + 1) AS BIGINT) AS size_bytes,
           round(sum(strlen(props) + 1) / 1024.0, 2) AS size_kb
    FROM events GROUP BY event_type""")
def file_inventory(spark, sf):
    """Files of known length: a text file per kind of event."""
    path = scratch_path(spark, "inventory")
    lines = fx.table(spark, sf, "events").select("event_type", "props")
    lines.repartition("event_type").write.partitionBy("event_type").text(path)
    return files.file_inventory(spark, path).select("prefix", "n_files", "size_bytes", "size_kb")


@query("sink_parquet_overwrite", with_tables("bars", body="""
    SELECT "Ticker", "Date", "Close" FROM bars"""))
def sink_parquet_overwrite(spark, sf):
    path = scratch_path(spark, "overwrite")
    bars = fx.bars(spark, sf).select("Ticker", "Date", "Close")
    sinks.write_features(bars, path)
    sinks.write_features(bars, path, codec="gzip")
    return spark.read.parquet(path)


@query("sink_partitioned_csv", with_tables("bars", body="""
    SELECT "Ticker", "Date", "Close", "Volume" FROM bars"""))
def sink_partitioned_csv(spark, sf):
    path = scratch_path(spark, "per-entity")
    bars = fx.bars(spark, sf).select("Ticker", "Date", "Close", "Volume")
    sinks.write_per_entity(bars, path)
    layout = "Date date, Close double, Volume long, Ticker string"
    return spark.read.schema(layout).option("header", True).csv(path)


@query("sink_json_docs", with_tables("logs", body="""
    SELECT run_id, pipeline, message, stack_trace FROM logs"""))
def sink_json_docs(spark, sf):
    path = scratch_path(spark, "json-docs")
    sinks.append_docs(fx.logs(spark, sf).select("run_id", "pipeline", "message", "stack_trace"), path)
    return files.read_docs(
        spark, path, "run_id long, pipeline string, message string, stack_trace string", multi_line=False
    )


@query("sink_bulk_ndjson", with_tables("logs", body="""
    SELECT '{"index":{"_index":"pipeline-logs","_id":"' || CAST(run_id AS VARCHAR) || '"}}' || chr(10)
        || '{"severity":"' || severity || '","pipeline":"' || pipeline || '","message":' || to_json(message)
        || ',"duration_ms":' || CAST(duration_ms AS VARCHAR)
        || CASE WHEN error_code IS NULL THEN '' ELSE ',"error_code":' || CAST(error_code AS VARCHAR) END
        || '}' AS value FROM logs"""))
def sink_bulk_ndjson(spark, sf):
    columns = ["severity", "pipeline", "message", "duration_ms", "error_code"]
    return sinks.to_bulk_ndjson(fx.logs(spark, sf), "pipeline-logs", "run_id", columns)


@query("sink_line_protocol", with_tables("logs", body=r"""
    SELECT 'pipeline_logs,severity=' || severity || ',flow=' || pipeline || ' message="'
        || replace(message, '"', '\"') || '",duration_ms=' || CAST(duration_ms AS VARCHAR) || 'i '
        || CAST(epoch_us("@timestamp") * 1000 AS VARCHAR) AS value FROM logs"""))
def sink_line_protocol(spark, sf):
    logs = fx.logs(spark, sf).withColumnRenamed("pipeline", "flow")
    return sinks.to_line_protocol(
        logs, "pipeline_logs", ["severity", "flow"], ["message", "duration_ms"], "@timestamp"
    )


@query("kafka_json_sink", with_tables("ticks", body="""
    SELECT ticker AS key, '{"timestamp":"' || "timestamp" || '","ticker":"' || ticker || '","open":'
        || CAST(open AS VARCHAR) || ',"high":' || CAST(high AS VARCHAR) || ',"low":' || CAST(low AS VARCHAR)
        || ',"close":' || CAST(close AS VARCHAR) || ',"volume":1}' AS value FROM ticks"""))
def kafka_json_sink(spark, sf):
    return sinks.to_kafka_value(fx.tick_rows(spark, sf).drop("event_id"), "ticker")


@query("sql_tables", """
    SELECT n_name, o_orderstatus, CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, o_orderstatus""")
def sql_tables(spark, sf):
    register_tables(spark, sf, ["orders", "customer", "nation"], prefix="lake_")
    return spark.sql("""
        SELECT n_name, o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
        FROM lake_orders JOIN lake_customer ON o_custkey = c_custkey JOIN lake_nation ON c_nationkey = n_nationkey
        GROUP BY n_name, o_orderstatus""")
