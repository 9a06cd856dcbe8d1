"""Inputs of the registered queries, derived from the given tables by Spark, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.scalar import packed_order
from candlewick.operators.bars import build_bars
from candlewick.operators.features import ml_features
from candlewick.operators.series import Series, Split

# The price level that plays the part of the index target.
TARGET = 250_000.0
NAMES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}
# One event is one point; event_id makes the order of equal times total. The few types are hot.
POINTS = Series(("ticker",), "ts", ("event_id",), Split("day"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of order prices by priority."""
    orders = table(spark, sf, "orders")
    return build_bars(orders, "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")


def market(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of all orders: the index series."""
    return build_bars(table(spark, sf, "orders"), F.lit("^ALL"), "o_orderdate", "o_totalprice", "o_orderkey")


def bars_many(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly bars per part: many series."""
    items = table(spark, sf, "lineitem")
    order = packed_order("l_shipdate", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return build_bars(
        items, F.col("l_partkey").cast("string"), "l_shipdate", "l_extendedprice", order, "month"
    )


def bars_hourly(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return build_bars(events, "event_type", "ts", "value", packed_order("ts", "event_id"), "hour")


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Raw event points by type: few, hot series."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("ticker"), "ts", "event_id", "value"
    )


def _row_number() -> Column:
    """A number per bar that both engines compute alike, to place damage."""
    return F.datediff("Date", F.lit("1995-01-01").cast("date")) * 5 + F.left("Ticker", F.lit(1)).cast("int")


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Bars with missing closes, zero opens and zero volumes."""
    n = _row_number()
    return bars(spark, sf).withColumns({
        "Close": F.when(n % 11 != 0, F.col("Close")),
        "Open": F.when(n % 13 == 0, F.lit(0.0)).otherwise(F.col("Open")),
        "Volume": F.when(n % 17 == 0, F.lit(0)).otherwise(F.col("Volume")).cast("long"),
    })


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as text with missing and wrong cells and repeated rows."""
    n = _row_number()
    texts = bars(spark, sf).withColumn("n", n).select(
        F.when(F.col("n") % 90 == 2, F.lit("not-a-date")).otherwise(F.col("Date").cast("string")).alias("Date"),
        "Ticker",
        *[F.col(c).cast("string").alias(c) for c in ("Open", "High", "Low")],
        F.when(F.col("n") % 50 == 0, None)
        .when(F.col("n") % 70 == 1, F.lit("n/a"))
        .otherwise(F.col("Close").cast("string")).alias("Close"),
        F.col("Volume").cast("string").alias("Volume"),
        F.when(F.col("n") % 40 == 3, 2).otherwise(1).alias("_copies"),
    )
    return texts.withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_c", "_copies")


def traders(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    number = F.col("c_custkey").cast("string")
    return customers.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 10 == 0, F.col("c_name"))
        .otherwise(F.concat_ws(" ", "c_mktsegment", "n_name")).alias("nama_lengkap"),
        F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com")
        ).alias("email"),
        F.concat(F.lit("08"), F.lpad(number, 10, "0")).alias("no_telepon"),
        F.concat(
            F.lit("Jl. "), "c_mktsegment", F.lit(" No. "), number, F.lit(", "), "n_name"
        ).alias("alamat"),
        F.col("c_acctbal").alias("saldo_investasi"),
        F.lit("moderate").alias("risk_profile"),
    )


def logs(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id")
    fatal = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("ts").alias("@timestamp"),
        F.when(fatal, "FATAL").when(n % 3 == 0, "INFO").when(n % 3 == 1, "DEBUG").otherwise("WARNING")
        .alias("severity"),
        F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string")).alias("pipeline"),
        F.col("props").alias("message"),
        n.alias("run_id"),
        F.floor(F.col("value") * 100).alias("duration_ms"),
        F.when(fatal, n % 9999).alias("error_code"),
        F.when(fatal, F.concat(F.lit("trace of "), n.cast("string"))).alias("stack_trace"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs: a log entry is a run, failed when fatal."""
    return logs(spark, sf).select(
        F.col("run_id").cast("string").alias("run_id"),
        F.col("@timestamp").alias("timestamp"),
        "pipeline",
        F.when(F.col("severity") == "FATAL", "failed").otherwise("completed").alias("status"),
        "duration_ms",
        F.when(F.col("severity") == "FATAL", F.repeat("message", F.lit(40))).alias("error"),
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Firing alerts: error events are critical, purchases warn, the others inform."""
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("alert"), (F.col("user_id") % 25).cast("string")).alias("alertname"),
        F.concat(F.lit("job"), F.hour("ts").cast("string")).alias("job"),
        F.when(F.col("event_type") == "error", "critical")
        .when(F.col("event_type") == "purchase", "warning").otherwise("info").alias("severity"),
        "ts",
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Long-format metric points: two fields per event."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    fields = F.array(
        F.struct(F.lit("k").alias("field"), k.alias("value")),
        F.struct(F.lit("value").alias("field"), F.col("value").alias("value")),
    )
    status = F.when(F.col("user_id") % 2 == 0, "success").otherwise("failed")
    return events.select(
        F.col("event_type").alias("measurement"),
        F.create_map(F.lit("status"), status).alias("tags"),
        "ts",
        "event_id",
        F.inline(fields),
    )


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows with a number for each volatility band in place of a model's cluster."""
    v = F.round("Volatility_5d", 6)
    band = F.when(v < 0.5, 0).when(v < 1, 1).when(v < 4, 2).when(v >= 4, 3)
    return ml_features(bars(spark, sf), keep_incomplete=True).withColumn("Cluster", band)


def tick_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as ticks, with the text time of the wire format."""
    price = F.col("value")
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type").alias("ticker"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        F.lit(1).cast("long").alias("volume"),
        "event_id",
    )


# --- the same in SQL -------------------------------------------------------------------------

W = 'PARTITION BY "Ticker" ORDER BY "Date"'


def _bars_sql(source: str, key: str, date: str, price: str, order: str) -> str:
    return f"""
        SELECT {key} AS "Ticker", {date} AS "Date",
               first({price} ORDER BY {order}) AS "Open", max({price}) AS "High",
               min({price}) AS "Low", last({price} ORDER BY {order}) AS "Close",
               CAST(count(*) AS BIGINT) AS "Volume"
        FROM {source} GROUP BY 1, 2"""


_N = """date_diff('day', DATE '1995-01-01', "Date") * 5 + CAST(left("Ticker", 1) AS INTEGER)"""


def features_sql(source: str) -> str:
    """All features of a bar table; incomplete rows are kept."""
    def over(rows: int) -> str:
        return f"({W} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"

    def mean(k: int) -> str:
        return f'CASE WHEN count("Close") OVER {over(k)} >= {k} THEN avg("Close") OVER {over(k)} END'

    filled = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
        SELECT "Ticker", "Date", "Open", "High", "Low", "Close", "Volume",
               "Returns_1d", "Returns_5d", "SMA_5", "SMA_20",
               CASE WHEN count("Returns_1d") OVER {over(5)} >= 5
                    THEN stddev_samp("Returns_1d") OVER {over(5)} END AS "Volatility_5d",
               "Volume_Change",
               "High" - "Low" AS "Price_Range",
               ("High" - "Low") / nullif("Open", 0) AS "Price_Range_Pct",
               "Close" / nullif("Open", 0) AS "Close_Open_Ratio",
               "High" / nullif("Low", 0) AS "High_Low_Ratio",
               lag("Close", 1) OVER ({W}) AS "Lag_1_Close",
               lag("Close", 2) OVER ({W}) AS "Lag_2_Close",
               lag("Close", 3) OVER ({W}) AS "Lag_3_Close",
               "SMA_5" - "SMA_20" AS "SMA_Cross",
               CASE WHEN count(*) OVER {over(14)} = 14 THEN
                    100 - 100 / (1 + avg(CASE WHEN step > 0 THEN step ELSE 0 END) OVER {over(14)}
                    / nullif(avg(CASE WHEN step < 0 THEN -step ELSE 0 END) OVER {over(14)}, 0)) END AS "RSI",
               coalesce(CAST(lead("Close") OVER ({W}) > "Close" AS INTEGER), 0) AS "Target_Up",
               lead("Close") OVER ({W}) - "Close" AS "Target_Change"
        FROM (
            SELECT *, c / nullif(lag(c, 1) OVER ({W}), 0) - 1 AS "Returns_1d",
                   c / nullif(lag(c, 5) OVER ({W}), 0) - 1 AS "Returns_5d",
                   v / nullif(lag(v, 1) OVER ({W}), 0) - 1 AS "Volume_Change",
                   "Close" - lag("Close") OVER ({W}) AS step,
                   {mean(5)} AS "SMA_5", {mean(20)} AS "SMA_20"
            FROM (
                SELECT *, last_value("Close" IGNORE NULLS) OVER {filled} AS c,
                       last_value("Volume" IGNORE NULLS) OVER {filled} AS v
                FROM {source}))"""


FEATURES = (
    "Returns_1d", "Returns_5d", "SMA_5", "SMA_20", "Volatility_5d", "Volume_Change", "Price_Range",
    "Price_Range_Pct", "Close_Open_Ratio", "High_Low_Ratio", "Lag_1_Close", "Lag_2_Close",
    "Lag_3_Close", "SMA_Cross", "RSI", "Target_Change",
)

# name: (tables it needs, body)
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), _bars_sql(
        "orders", "o_orderpriority", "CAST(o_orderdate AS DATE)", "o_totalprice", "o_orderkey")),
    "market": ((), _bars_sql(
        "orders", "'^ALL'", "CAST(o_orderdate AS DATE)", "o_totalprice", "o_orderkey")),
    "bars_many": ((), _bars_sql(
        "lineitem", "CAST(l_partkey AS VARCHAR)", "CAST(date_trunc('month', l_shipdate) AS DATE)",
        "l_extendedprice", "l_shipdate, l_orderkey, l_linenumber")),
    "bars_hourly": ((), _bars_sql(
        "events", "event_type", "date_trunc('hour', ts)", "value", "ts, event_id")),
    "points": ((), "SELECT event_type AS ticker, ts, event_id, value FROM events"),
    "gappy": (("bars",), f"""
        SELECT "Ticker", "Date", CASE WHEN n % 13 = 0 THEN 0.0 ELSE "Open" END AS "Open", "High", "Low",
               CASE WHEN n % 11 <> 0 THEN "Close" END AS "Close",
               CASE WHEN n % 17 = 0 THEN 0 ELSE "Volume" END AS "Volume"
        FROM (SELECT *, {_N} AS n FROM bars)"""),
    "dirty": (("bars",), f"""
        SELECT CASE WHEN n % 90 = 2 THEN 'not-a-date' ELSE CAST("Date" AS VARCHAR) END AS "Date", "Ticker",
               CAST("Open" AS VARCHAR) AS "Open", CAST("High" AS VARCHAR) AS "High",
               CAST("Low" AS VARCHAR) AS "Low",
               CASE WHEN n % 50 = 0 THEN NULL WHEN n % 70 = 1 THEN 'n/a'
                    ELSE CAST("Close" AS VARCHAR) END AS "Close",
               CAST("Volume" AS VARCHAR) AS "Volume"
        FROM (SELECT *, {_N} AS n,
                     unnest(range(CASE WHEN ({_N}) % 40 = 3 THEN 2 ELSE 1 END)) AS copy FROM bars)"""),
    "traders": ((), """
        SELECT c_custkey AS user_id,
               CASE WHEN c_custkey % 10 = 0 THEN c_name ELSE c_mktsegment || ' ' || n_name END AS nama_lengkap,
               lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' AS email,
               '08' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS no_telepon,
               'Jl. ' || c_mktsegment || ' No. ' || CAST(c_custkey AS VARCHAR) || ', ' || n_name AS alamat,
               c_acctbal AS saldo_investasi, 'moderate' AS risk_profile
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "logs": ((), """
        SELECT ts AS "@timestamp",
               CASE WHEN event_type = 'error' THEN 'FATAL' WHEN event_id % 3 = 0 THEN 'INFO'
                    WHEN event_id % 3 = 1 THEN 'DEBUG' ELSE 'WARNING' END AS severity,
               'p' || CAST(user_id % 5 AS VARCHAR) AS pipeline, props AS message, event_id AS run_id,
               CAST(floor(value * 100) AS BIGINT) AS duration_ms,
               CASE WHEN event_type = 'error' THEN event_id % 9999 END AS error_code,
               CASE WHEN event_type = 'error' THEN 'trace of ' || CAST(event_id AS VARCHAR) END AS stack_trace
        FROM events"""),
    "runs": (("logs",), """
        SELECT CAST(run_id AS VARCHAR) AS run_id, "@timestamp" AS "timestamp", pipeline,
               CASE WHEN severity = 'FATAL' THEN 'failed' ELSE 'completed' END AS status, duration_ms,
               CASE WHEN severity = 'FATAL' THEN repeat(message, 40) END AS error
        FROM logs"""),
    "alerts": ((), """
        SELECT event_id, 'alert' || CAST(user_id % 25 AS VARCHAR) AS alertname,
               'job' || CAST(hour(ts) AS VARCHAR) AS job,
               CASE WHEN event_type = 'error' THEN 'critical' WHEN event_type = 'purchase' THEN 'warning'
                    ELSE 'info' END AS severity, ts
        FROM events"""),
    "metrics": ((), """
        SELECT event_type AS measurement, CASE WHEN user_id % 2 = 0 THEN 'success' ELSE 'failed' END AS status,
               ts, event_id, 'k' AS field, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value
        FROM events
        UNION ALL
        SELECT event_type, CASE WHEN user_id % 2 = 0 THEN 'success' ELSE 'failed' END, ts, event_id, 'value', value
        FROM events"""),
    "features": (("bars",), features_sql("bars")),
    "market_features": (("market",), features_sql("market")),
    "clusters": (("features",), """
        SELECT *, CASE WHEN round("Volatility_5d", 6) < 0.5 THEN 0 WHEN round("Volatility_5d", 6) < 1 THEN 1
                       WHEN round("Volatility_5d", 6) < 4 THEN 2 WHEN round("Volatility_5d", 6) >= 4 THEN 3
                  END AS "Cluster"
        FROM features"""),
    "ticks": ((), """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS ticker, value AS open,
               value AS high, value AS low, value AS close, CAST(1 AS BIGINT) AS volume, event_id, ts
        FROM events"""),
}


def with_tables(*names: str, body: str) -> str:
    """``body`` after a WITH clause that defines the named fixtures and what they need."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in _TABLES[name][0]:
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    clause = ",\n".join(f"{n} AS ({_TABLES[n][1]})" for n in needed)
    return f"WITH {clause}\n{body}"


def round_sql(columns, digits: int = 6) -> str:
    """Select list of rounded columns."""
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)
