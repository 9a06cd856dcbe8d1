"""Log, alert and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import monitor
from candlewick.operators.bars import with_daily_change
from candlewick.operators.joins import with_symbol_name
from candlewick.operators.series import Series, Split
from candlewick.operators.summary import latest_per_key
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded
from candlewick.session import scratch_path
from candlewick.sources.files import read_text_docs, read_text_heads


def _documents(spark, sf):
    """Events as stored documents of mixed form: objects with different fields, lists, plain text."""
    n = F.col("event_id")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    full = F.to_json(F.struct(
        stamp.alias("timestamp"), F.lit("WARNING").alias("severity"), F.lit("batch").alias("pipeline"),
        F.concat(F.lit("note "), F.col("event_type")).alias("message"), n.cast("string").alias("run_id"),
        F.floor(F.col("value") * 100).alias("duration_ms"),
    ))
    sparse = F.to_json(F.struct(
        stamp.alias("@timestamp"), F.lit("DEBUG").alias("level"), F.lit("").alias("pipeline"),
        F.lit("stream").alias("flow"), F.lit("completed").alias("status"),
    ))
    content = (
        F.when(n % 5 == 0, full).when(n % 5 == 1, sparse).when(n % 5 == 2, F.col("props"))
        .when(n % 5 == 3, F.concat(F.lit("[1, 2, "), n.cast("string"), F.lit("]")))
        .otherwise(F.repeat(F.concat(F.lit("line of "), F.col("event_type"), F.lit("; ")), F.lit(60)))
    )
    return fx.table(spark, sf, "events").select(
        content.alias("content"),
        F.concat(F.lit("logs/"), n.cast("string"), F.lit(".json")).alias("source_file"),
        F.col("ts").cast("timestamp").alias("modified"),
    )


@query("normalize_logs", """
    SELECT ts AS "@timestamp",
           CASE event_id % 5 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'DEBUG' ELSE 'INFO' END AS severity,
           CASE event_id % 5 WHEN 0 THEN 'batch' WHEN 1 THEN 'stream' ELSE 'unknown' END AS pipeline,
           CASE event_id % 5 WHEN 0 THEN 'note ' || event_type WHEN 1 THEN 'completed' WHEN 2 THEN props
                ELSE left(repeat('line of ' || event_type || '; ', 60), 500) END AS message,
           CASE WHEN event_id % 5 = 0 THEN CAST(event_id AS VARCHAR) END AS run_id,
           CASE WHEN event_id % 5 = 0 THEN CAST(floor(value * 100) AS BIGINT) END AS duration_ms,
           CAST(NULL AS BIGINT) AS error_code, CAST(NULL AS VARCHAR) AS stack_trace,
           'logs/' || CAST(event_id AS VARCHAR) || '.json' AS source_file
    FROM events WHERE event_id % 5 <> 3""")
def normalize_logs(spark, sf):
    logs = monitor.normalize_docs(_documents(spark, sf)).drop("fields", "reject")
    return logs.withColumn("@timestamp", F.col("@timestamp").cast("timestamp_ntz"))


_WHOLE = """
    SELECT event_type AS area, day(ts) AS day, CAST(count(*) AS VARCHAR) AS n, CAST(max(event_id) AS VARCHAR) AS m
    FROM events GROUP BY 1, 2"""


@query("normalize_whole_logs", f"""
    SELECT 'area=' || area || '/day=' || CAST(day AS VARCHAR) AS source_file,
           CASE day % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'FATAL' WHEN 2 THEN 'WARNING' ELSE 'INFO' END AS severity,
           CASE day % 4 WHEN 0 THEN 'batch' WHEN 1 THEN 'ml' ELSE 'unknown' END AS pipeline,
           CASE day % 4 WHEN 1 THEN 'duplicate_key' WHEN 2 THEN 'duplicate_key' WHEN 3 THEN 'not_json' END AS reject,
           CASE day % 4 WHEN 0 THEN 'flag=true;flow="batch";n=' || n || ';tags={{"area":"' || area || '","list":[' || n || ',1.5]}}'
                WHEN 1 THEN 'n=' || n || ';note="' || m || 'x"'
                WHEN 2 THEN 'level="WARNING";n=' || n || ';note="' || m || 'x";tags="{{\\"a\\":1,\\"a\\":2}}"' END AS fields,
           CASE day % 4 WHEN 0 THEN 'whole' WHEN 3 THEN '{{"severity":"FATAL"}} ' || n ELSE 'note' END AS message
    FROM ({_WHOLE})""")
def normalize_whole_logs(spark, sf):
    """A document per area and day, each read back as a file: whole objects, repeated keys on top and
    inside, and an object with text behind it. No field and no severity is lost."""
    days = fx.table(spark, sf, "events").groupBy(F.col("event_type").alias("area"), F.dayofmonth("ts").alias("day")).agg(
        F.count(F.lit(1)).cast("string").alias("n"), F.max("event_id").cast("string").alias("m")
    )
    text = lambda form, *values: F.format_string(form, *values)
    content = (
        F.when(F.col("day") % 4 == 0, text(
            '{"severity":"ERROR","flow":"batch","message":"whole","n":%s,"tags":{"area":"%s","list":[%s,1.5]},"none":null,"flag":true}',
            "n", "area", "n"))
        .when(F.col("day") % 4 == 1, text(
            '{"severity":"INFO","n":0,"severity":"FATAL","n":%s,"pipeline":"ml","note":"%sx","message":"note"}', "n", "m"))
        .when(F.col("day") % 4 == 2, text('{"level":"WARNING","tags":{"a":1,"a":2},"n":%s,"note":"%sx","message":"note"}', "n", "m"))
        .otherwise(text('{"severity":"FATAL"} %s', "n"))
    )
    path = scratch_path(spark, "wholelogs")
    days.select("area", "day", content.alias("value")).write.partitionBy("area", "day").text(path)
    logs = monitor.normalize_docs(read_text_docs(spark, path))
    listed = F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return logs.select(
        F.regexp_extract("source_file", r"area=[^/]+/day=[0-9]+", 0).alias("source_file"), "severity", "pipeline", "reject",
        F.array_join(F.array_sort(listed), ";").alias("fields"), "message",
    )


_AREA = """CASE pipeline WHEN 'p0' THEN 'batch' WHEN 'p1' THEN 'stream' WHEN 'p2' THEN 'ml' ELSE 'other' END"""


@query("normalize_text_logs", with_tables("logs", body=f"""
    SELECT 'INFO' AS severity, CASE {_AREA} WHEN 'other' THEN 'unknown' ELSE {_AREA} END AS pipeline,
           left(string_agg(CAST("@timestamp" AS VARCHAR) || ' ' || severity || ' ' || message, chr(10)
                ORDER BY "@timestamp", run_id) || chr(10), 500) AS message,
           'area=' || {_AREA} || '/day=' || CAST(day("@timestamp") AS VARCHAR) AS source_file
    FROM logs GROUP BY {_AREA}, day("@timestamp")
    UNION ALL SELECT 'INFO', 'unknown', '', 'area=none/day=0'"""))
def normalize_text_logs(spark, sf):
    """A log file per area and day, and one empty file; then one entry per file."""
    area = (
        F.when(F.col("pipeline") == "p0", "batch").when(F.col("pipeline") == "p1", "stream")
        .when(F.col("pipeline") == "p2", "ml").otherwise("other")
    )
    lines = fx.logs(spark, sf).select(
        area.alias("area"), F.dayofmonth("@timestamp").alias("day"), "@timestamp", "run_id",
        F.concat_ws(" ", F.col("@timestamp").cast("string"), "severity", "message").alias("value"),
    )
    path = scratch_path(spark, "textlogs")
    ordered = lines.repartition("area", "day").sortWithinPartitions("area", "day", "@timestamp", "run_id")
    ordered.select("area", "day", "value").write.partitionBy("area", "day").text(path)
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/area=none/day=0")
    docs = read_text_heads(spark, path, monitor.MESSAGE_LENGTH).withColumn(
        "source_file", F.regexp_extract("source_file", r"area=[^/]+/day=[0-9]+", 0)
    )
    return monitor.normalize_text_logs(docs).drop("@timestamp")


@query("fatal_errors", with_tables("logs", body="""
    SELECT "@timestamp", pipeline, message, run_id, error_code, stack_trace FROM logs WHERE severity = 'FATAL'"""))
def fatal_errors(spark, sf):
    return monitor.fatal_errors(fx.logs(spark, sf))


@query("freshness_alert", """
    SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS job, max(ts) FILTER (user_id % 7 <> 0) AS last_success,
           round(epoch_us((SELECT max(ts) FROM events)) / 1000000.0
                 - epoch_us(max(ts) FILTER (user_id % 7 <> 0)) / 1000000.0, 3) AS age_seconds
    FROM events GROUP BY 1
    HAVING epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts) FILTER (user_id % 7 <> 0)) > 86400000000""")
def freshness_alert(spark, sf):
    events = fx.table(spark, sf, "events")
    runs = events.select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("job"),
        F.when(F.col("user_id") % 7 != 0, "completed").otherwise("failed").alias("status"), "ts",
    )
    newest = events.agg(F.max("ts")).scalar()
    return rounded(monitor.freshness(runs, now=newest, job="job", ts="ts"), 3)


@query("freshness_held", """
    SELECT job, ts AS last_success, ts + INTERVAL 86400 SECOND AS pending_since, ts + INTERVAL 86700 SECOND AS firing_since,
           after AS resolved_at
    FROM (SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS job, ts, event_id,
                 lead(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS after
          FROM events WHERE user_id % 7 <> 0)
    WHERE coalesce(after, (SELECT max(ts) FROM events)) > ts + INTERVAL 86700 SECOND""")
def freshness_held(spark, sf):
    """Periods in which a job's last success was over a day old for more than five minutes."""
    events = fx.table(spark, sf, "events")
    runs = events.select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("job"),
        F.when(F.col("user_id") % 7 != 0, "completed").otherwise("failed").alias("status"), "ts", "event_id",
    )
    newest = events.agg(F.max("ts")).scalar()
    series = Series(("job",), "ts", ("event_id",), Split("day"))
    return monitor.stale_periods(runs, series, now=newest)


@query("run_summary", with_tables("runs", body="""
    SELECT pipeline, CAST(count(*) AS BIGINT) AS runs, CAST(count(*) FILTER (status = 'completed') AS BIGINT) AS completed,
           CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS failed, max("timestamp") AS last_run
    FROM runs GROUP BY 1"""))
def run_summary(spark, sf):
    return monitor.run_summary(fx.runs(spark, sf))


@query("failure_message", with_tables("runs", body="""
    SELECT pipeline, "timestamp", '[Alert] Pipeline Failed: ' || pipeline AS subject,
           'Flow: ' || pipeline || chr(10) || 'Error: ' || left(error, 500) || chr(10) || 'Time: '
               || strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS body,
           'Pipeline Alert' || chr(10) || 'Flow: ' || pipeline || chr(10) || 'Error: ' || left(error, 200) AS chat
    FROM runs WHERE status = 'failed'"""))
def failure_message(spark, sf):
    return monitor.failure_messages(fx.runs(spark, sf))


@query("return_volatility_points", with_tables("clusters", body="""
    SELECT "Ticker", CASE "Ticker" WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
                     WHEN '3-MEDIUM' THEN 'Medium' END AS "Nama_Saham",
           round("Returns_1d", 6) AS "Returns_1d", round("Volatility_5d", 6) AS "Volatility_5d", "Cluster"
    FROM clusters WHERE "Cluster" IS NOT NULL"""))
def return_volatility_points(spark, sf):
    return rounded(monitor.scatter_points(with_symbol_name(fx.clusters(spark, sf), fx.NAMES)))


@query("daily_change_table", with_tables("bars_many", body="""
    SELECT "Ticker", max("Date") AS "Date", arg_max(pct, "Date") AS "Daily_Change_Pct" FROM (
        SELECT "Ticker", "Date", round(("Close" - "Open") / nullif("Open", 0) * 100, 2) AS pct FROM bars_many)
    GROUP BY 1"""))
def daily_change_table(spark, sf):
    changes = with_daily_change(fx.bars_many(spark, sf), round_to=2)
    return latest_per_key(changes, columns=["Daily_Change_Pct"])


@query("job_duration_series", with_tables("logs", body="""
    SELECT pipeline, date_trunc('hour', "@timestamp") AS period, round(avg(duration_ms), 4) AS avg_ms,
           max(duration_ms) AS max_ms, CAST(count(*) AS BIGINT) AS runs FROM logs GROUP BY 1, 2"""))
def job_duration_series(spark, sf):
    return rounded(monitor.duration_series(fx.logs(spark, sf)), 4)


@query("slowest_runs", with_tables("logs", body="""
    SELECT run_id, pipeline, duration_ms FROM logs ORDER BY duration_ms DESC, run_id LIMIT 20"""))
def slowest_runs(spark, sf):
    logs = fx.logs(spark, sf).select("run_id", "pipeline", "duration_ms")
    return monitor.slowest_runs(logs, 20, tie=["run_id"])
