"""Streaming queries: events are replayed through Structured Streaming until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded
from candlewick.session import scratch_path
from candlewick.sources.files import file_inventory as inventory
from candlewick.sources.sinks import to_kafka_value, write_text
from candlewick.streaming import ticks as tk

ONCE = {"availableNow": True}
# Wider than the data, for replays whose parts overlap in time.
WIDE = "4000 days"


def _payload(rows):
    return to_kafka_value(rows.drop("event_id"))


def _stream(spark, path):
    return tk.read_ticks(spark, {"path": path}, fmt="text")


def _drain(query):
    query.awaitTermination()
    return query


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


_WINDOWS = """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, ticker,
           round(avg(close), 6) AS avg_close, max(close) AS max_close, min(close) AS min_close,
           round(avg(open), 6) AS avg_open, CAST(sum(volume) AS BIGINT) AS total_volume
    FROM ticks GROUP BY 1, 2, 3"""


@query("kafka_json_source", with_tables("ticks", body="""
    SELECT "timestamp", ticker, open, high, low, close, volume, ts AS event_time FROM ticks"""))
def kafka_json_source(spark, sf):
    """JSON lines arrive on a stream, are parsed and stored."""
    path = scratch_path(spark, "source-in")
    write_text(_payload(fx.tick_rows(spark, sf)), path)
    out = scratch_path(spark, "source-out")
    parsed = tk.accepted(_stream(spark, path))
    _drain(
        parsed.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "source-ck")).trigger(**ONCE).start()
    )
    return _ntz(spark.read.parquet(out), "event_time")


_BROKEN = """
    SELECT event_id, ticker, CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'bad_time' END
        AS reject FROM ticks"""


@query("stream_parse", with_tables("ticks", body=f"""
    SELECT coalesce(reject, 'ok') AS outcome, CASE WHEN reject = 'malformed' THEN NULL ELSE ticker END AS ticker,
           CAST(count(*) AS BIGINT) AS n FROM ({_BROKEN}) GROUP BY 1, 2"""))
def stream_parse(spark, sf):
    """Good, malformed and mistimed messages on one stream; each row lands in one outcome."""
    rows = fx.tick_rows(spark, sf)
    stamp = F.when(F.col("event_id") % 89 == 0, "not-a-time").otherwise(F.col("timestamp"))
    columns = ["timestamp", "ticker", "open", "high", "low", "close", "volume"]
    whole = F.to_json(F.struct(*columns))
    text = F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    path = scratch_path(spark, "parse-in")
    write_text(rows.withColumn("timestamp", stamp).select(text.alias("value")), path)
    out = scratch_path(spark, "parse-out")
    parsed = _stream(spark, path)
    _drain(
        parsed.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "parse-ck")).trigger(**ONCE).start()
    )
    outcome = F.coalesce("reject", F.lit("ok")).alias("outcome")
    known = F.when(F.col("reject").eqNullSafe("malformed"), None).otherwise(F.col("ticker")).alias("ticker")
    return spark.read.parquet(out).groupBy(outcome, known).agg(F.count(F.lit(1)).alias("n"))


def _slots(rows, n, delay="0"):
    """Rows with the number of the part in which they arrive: ``n`` parts of equal time, in order of time."""
    micros = F.unix_micros(F.to_timestamp("timestamp"))
    ends = rows.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    step = (ends["high"] - ends["low"]) // n + 1
    slot = F.expr(f"(unix_micros(to_timestamp(timestamp)) - {ends['low']}) div {step}") + F.expr(delay)
    return rows.withColumn("slot", F.least(slot, F.lit(n - 1)))


@query("stream_tumbling_5m", with_tables("ticks", body=_WINDOWS))
def stream_tumbling_5m(spark, sf):
    """Three arrivals in order of time, each a micro-batch in update mode; closed days are compacted on
    the way, and the final row of each window is read from closed and open days together."""
    path, out = scratch_path(spark, "windows-in"), scratch_path(spark, "windows-out")
    closed, checkpoint = scratch_path(spark, "windows-closed"), scratch_path(spark, "windows-ck")
    rows = _slots(fx.tick_rows(spark, sf), 3)
    for part in range(3):
        write_text(_payload(rows.filter(F.col("slot") == part).drop("slot")), path, mode="append")
        windows = tk.tick_windows(tk.accepted(_stream(spark, path)))
        _drain(tk.start_sink(windows, out, checkpoint, trigger=ONCE, rows_per_file=1_000_000))
        if part == 1:
            tk.compact_days(spark, out, closed, tk.closed_days(spark, out))
    return rounded(_ntz(tk.read_windows(spark, out, closed), "window_start", "window_end"))


@query("stream_update_upsert", with_tables("ticks", body=_WINDOWS))
def stream_update_upsert(spark, sf):
    """Two arrivals touch the same windows, so most are emitted twice; one row of each remains."""
    path, out = scratch_path(spark, "upsert-in"), scratch_path(spark, "upsert-out")
    checkpoint = scratch_path(spark, "upsert-ck")
    rows = fx.tick_rows(spark, sf)
    for part in (0, 1):
        write_text(_payload(rows.filter(F.col("event_id") % 2 == part)), path, mode="append")
        windows = tk.tick_windows(tk.accepted(_stream(spark, path)), watermark=WIDE)
        _drain(tk.start_sink(windows, out, checkpoint, trigger=ONCE, writers=2))
    return rounded(_ntz(tk.upsert_latest(spark.read.parquet(out)), "window_start", "window_end"))


@query("foreach_batch_sink", with_tables("ticks", body=f"""
    SELECT CAST(window_start AS DATE) AS dt, ticker, CAST(count(*) AS BIGINT) AS n_windows,
           CAST(sum(total_volume) AS BIGINT) AS n_ticks FROM ({_WINDOWS}) GROUP BY 1, 2"""))
def foreach_batch_sink(spark, sf):
    """The dated table the sink leaves behind, summed per day folder."""
    path, out = scratch_path(spark, "dated-in"), scratch_path(spark, "dated-out")
    write_text(_payload(fx.tick_rows(spark, sf)), path)
    windows = tk.tick_windows(tk.accepted(_stream(spark, path)))
    _drain(tk.start_sink(windows, out, scratch_path(spark, "dated-ck"), trigger=ONCE, writers=2))
    return spark.read.parquet(out).groupBy("dt", "ticker").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("total_volume").alias("n_ticks")
    )


_LATE_SLOTS = 6

_LATE = f"""
    SELECT dense_rank() OVER (ORDER BY slot) - 1 AS batch_id, slot, ts,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end
    FROM (SELECT ts, least({_LATE_SLOTS - 1}, (epoch_us(ts) - t_low) // ((t_high - t_low) // {_LATE_SLOTS} + 1) + event_id % 7 // 5) AS slot
          FROM ticks, (SELECT min(epoch_us(ts)) AS t_low, max(epoch_us(ts)) AS t_high FROM ticks))"""


@query("stream_late_drop", with_tables("ticks", body=f"""
    SELECT batch_id, CAST(count(*) AS BIGINT) AS n_ticks, CAST(count(*) FILTER (window_end <= watermark) AS BIGINT) AS n_late
    FROM ({_LATE}) JOIN (
        SELECT batch_id, max(max(ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 10 MINUTE AS watermark
        FROM ({_LATE}) GROUP BY batch_id) USING (batch_id)
    GROUP BY batch_id"""))
def stream_late_drop(spark, sf):
    """Arrivals in order of time, but two ticks in seven come one arrival later: how many ticks of each
    micro-batch are behind the watermark that the earlier ones set."""
    path, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    checkpoint = scratch_path(spark, "late-ck")
    rows = _slots(fx.tick_rows(spark, sf), _LATE_SLOTS, "event_id % 7 div 5")
    for part in range(_LATE_SLOTS):
        write_text(_payload(rows.filter(F.col("slot") == part).drop("slot")), path, mode="append")
        _drain(tk.start_late_audit(tk.accepted(_stream(spark, path)), out, checkpoint, trigger=ONCE))
    return tk.late_batches(spark, out).select("batch_id", "n_ticks", "n_late")


@query("stream_file_count", with_tables("ticks", body="""
    SELECT DISTINCT 'dt=' || CAST(CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS DATE) AS VARCHAR) AS prefix,
           CAST(1 AS BIGINT) AS n_files FROM ticks"""))
def stream_file_count(spark, sf):
    """Number of the files a windowed stream left behind: rows that fit a file are one for each day and batch."""
    path, out = scratch_path(spark, "count-in"), scratch_path(spark, "count-out")
    write_text(_payload(fx.tick_rows(spark, sf)), path)
    windows = tk.tick_windows(tk.accepted(_stream(spark, path)))
    _drain(tk.start_sink(windows, out, scratch_path(spark, "count-ck"), trigger=ONCE, rows_per_file=1_000_000))
    return inventory(spark, out).select("prefix", "n_files")


@query("stream_predict_features", with_tables("ticks", body="""
    SELECT event_id, ticker, CAST(0 AS DOUBLE) AS "Returns_1d", CAST(50 AS DOUBLE) AS "RSI",
           round((high - low) / greatest(coalesce(open, 1), 0.01), 6) AS "Price_Range_Pct",
           round(close / greatest(coalesce(open, 1), 0.01), 6) AS "Close_Open_Ratio",
           CAST(volume AS DOUBLE) AS "Volume", event_id % 5 AS cluster,
           CASE WHEN event_id % 5 >= 3 THEN 'high' WHEN event_id % 5 >= 2 THEN 'medium' ELSE 'low' END AS risk_level,
           CASE WHEN event_id % 5 <= 1 THEN 'bullish' ELSE 'bearish' END AS market_sentiment FROM ticks"""))
def stream_predict_features(spark, sf):
    ticks = tk.tick_features(fx.tick_rows(spark, sf)).withColumn("cluster", F.col("event_id") % 5)
    return rounded(tk.with_risk_labels(ticks).select(
        "event_id", "ticker", "Returns_1d", "RSI", "Price_Range_Pct", "Close_Open_Ratio", "Volume", "cluster",
        "risk_level", "market_sentiment",
    ))
