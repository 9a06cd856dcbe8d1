"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions import scalar as s
from candlewick.operators import bars as bar_ops
from candlewick.operators import filters
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded
from candlewick.schemas import DAYS_BANDS, DAYS_BELOW, SCORE_BANDS, SCORE_BELOW

BAR = '"Ticker", "Date", "Open", "High", "Low", "Close", "Volume"'


@query("daily_change", with_tables("gappy", body=f"""
    SELECT {BAR}, round("Close" - "Open", 6) AS "Daily_Change",
           round(("Close" - "Open") / nullif("Open", 0) * 100, 6) AS "Daily_Change_Pct" FROM gappy"""))
def daily_change(spark, sf):
    return rounded(bar_ops.with_daily_change(fx.gappy(spark, sf)))


@query("daily_change_rounded", with_tables("bars_many", body=f"""
    SELECT {BAR}, round("Close" - "Open", 2) AS "Daily_Change",
           round(("Close" - "Open") / nullif("Open", 0) * 100, 2) AS "Daily_Change_Pct" FROM bars_many"""))
def daily_change_rounded(spark, sf):
    return bar_ops.with_daily_change(fx.bars_many(spark, sf), round_to=2)


@query("intraday_volatility", with_tables("gappy", body="""
    SELECT "Ticker", "Date", round(("High" - "Low") / nullif("Open", 0), 6) AS "Volatility" FROM gappy"""))
def intraday_volatility(spark, sf):
    df = bar_ops.with_intraday_volatility(fx.gappy(spark, sf))
    return rounded(df.select("Ticker", "Date", "Volatility"))


@query("price_range", with_tables("bars", body="""
    SELECT "Ticker", "Date", round("High" - "Low", 6) AS "Price_Range" FROM bars"""))
def price_range(spark, sf):
    return rounded(bar_ops.with_price_range(fx.bars(spark, sf)).select("Ticker", "Date", "Price_Range"))


@query("range_ratios", with_tables("gappy", body="""
    SELECT "Ticker", "Date", round(("High" - "Low") / nullif("Open", 0), 6) AS "Price_Range_Pct",
           round("Close" / nullif("Open", 0), 6) AS "Close_Open_Ratio",
           round("High" / nullif("Low", 0), 6) AS "High_Low_Ratio" FROM gappy"""))
def range_ratios(spark, sf):
    df = bar_ops.with_range_ratios(fx.gappy(spark, sf))
    return rounded(df.select("Ticker", "Date", "Price_Range_Pct", "Close_Open_Ratio", "High_Low_Ratio"))


def _listed(spark, sf):
    """Event points under exchange-style symbols."""
    kind = F.col("event_type")
    return fx.table(spark, sf, "events").select(
        "event_id",
        F.when(kind.isin("click", "view"), F.concat(F.lit("^"), kind))
        .when(kind == "error", F.concat(kind, F.lit(".JK"))).otherwise(kind).alias("Ticker"),
        "value",
    )


_LISTED = """
    SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN '^' || event_type
                          WHEN event_type = 'error' THEN event_type || '.JK' ELSE event_type END AS "Ticker", value
    FROM events"""


@query("normalize_ticker", f"""
    SELECT event_id, "Ticker", replace(replace("Ticker", '.JK', ''), '^', '') AS symbol FROM ({_LISTED})""")
def normalize_ticker(spark, sf):
    return _listed(spark, sf).select("event_id", "Ticker", s.normalize_symbol("Ticker").alias("symbol"))


@query("index_filter", f"""
    SELECT event_id, "Ticker", value FROM ({_LISTED})
    WHERE contains(replace(replace("Ticker", '.JK', ''), '^', ''), 'click')""")
def index_filter(spark, sf):
    return filters.filter_symbol(_listed(spark, sf), "^click")


@query("symbol_in_filter", f"""
    SELECT event_id, "Ticker", value FROM ({_LISTED}) WHERE "Ticker" IN ('^view', 'error.JK', 'absent')""")
def symbol_in_filter(spark, sf):
    return filters.filter_symbols(_listed(spark, sf), ["^view", "error.JK", "absent"])


@query("drop_null_inf", with_tables("gappy", body="""
    SELECT "Ticker", "Date", round(ratio, 6) AS ratio FROM (
        SELECT "Ticker", "Date", "Close" / nullif("Open", 0) AS ratio FROM gappy)
    WHERE ratio IS NOT NULL"""))
def drop_null_inf(spark, sf):
    # The division is made to give an infinity, as an unguarded engine would.
    raw = F.when(F.col("Open") == 0, F.lit(float("inf"))).otherwise(s.ratio("Close", "Open"))
    df = fx.gappy(spark, sf).select("Ticker", "Date", raw.alias("ratio"))
    return rounded(filters.drop_incomplete(df, ["ratio"]))


@query("time_range_filter", """
    SELECT event_id, ts, event_type, value FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def time_range_filter(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return filters.since(events, "ts", "7 days")


@query("measurement_field_filter", with_tables("metrics", body="""
    SELECT event_id, ts, value FROM metrics WHERE measurement = 'purchase' AND field = 'k'"""))
def measurement_field_filter(spark, sf):
    return filters.metric(fx.metrics(spark, sf), "purchase", "k").select("event_id", "ts", "value")


@query("flatten_json", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def flatten_json(spark, sf):
    events = fx.table(spark, sf, "events")
    return events.select("event_id", s.parse_json("props", "k bigint").alias("data")).select("event_id", "data.*")


@query("fn_dates", with_tables("dirty", "ticks", body="""
    SELECT 'bar' AS origin, "Date" AS given, TRY_CAST("Date" AS DATE) AS day,
           TRY_CAST("Date" AS DATE) + 3 AS later, CAST(NULL AS TIMESTAMP) AS moment FROM dirty
    UNION ALL
    SELECT 'tick', "timestamp", CAST(ts AS DATE), CAST(ts AS DATE) + 3, ts FROM ticks"""))
def fn_dates(spark, sf):
    day = s.parse_date("Date", "yyyy-MM-dd")
    bars = fx.dirty(spark, sf).select(
        F.lit("bar").alias("origin"), F.col("Date").alias("given"), day.alias("day"),
        F.date_add(day, 3).alias("later"), F.lit(None).cast("timestamp_ntz").alias("moment"),
    )
    moment = s.parse_timestamp("timestamp")
    ticks = fx.tick_rows(spark, sf).select(
        F.lit("tick").alias("origin"), F.col("timestamp").alias("given"), moment.cast("date").alias("day"),
        F.date_add(moment.cast("date"), 3).alias("later"), moment.cast("timestamp_ntz").alias("moment"),
    )
    return bars.unionByName(ticks)


@query("fn_round_float", """
    SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 2) AS two,
           round(sqrt(l_extendedprice), 1) AS one FROM lineitem""")
def fn_round_float(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    root = F.sqrt("l_extendedprice")
    df = items.select("l_orderkey", "l_linenumber", root.alias("two"), root.alias("one"))
    return s.round_cols(s.round_cols(df, ["two"], 2), ["one"], 1)


@query("fn_coalesce_chain", """
    SELECT event_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN event_type END, ''),
                              nullif(CASE WHEN event_id % 2 = 0 THEN props END, ''), 'unknown') AS label FROM events""")
def fn_coalesce_chain(spark, sf):
    n = F.col("event_id")
    first = F.when(n % 3 == 0, "").when(n % 3 == 1, F.col("event_type"))
    second = F.when(n % 2 == 0, F.col("props"))
    events = fx.table(spark, sf, "events")
    return events.select("event_id", s.first_non_empty(first, second, default="unknown").alias("label"))


@query("fn_substring_case", """
    SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN 'warm' WHEN contains(p_name, 'ring') THEN 'round'
                           WHEN contains(p_name, 'blue') THEN 'cold' ELSE 'unknown' END AS class FROM part""")
def fn_substring_case(spark, sf):
    rules = [("red", "warm"), ("ring", "round"), ("blue", "cold")]
    return fx.table(spark, sf, "part").select("p_partkey", s.classify("p_name", rules, "unknown").alias("class"))


@query("fn_truncate", 'SELECT doc_id, left("text", 500) AS long_text, left("text", 200) AS short_text FROM documents')
def fn_truncate(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", s.truncate("text", 500).alias("long_text"), s.truncate("text", 200).alias("short_text")
    )


@query("fn_floor_clip", with_tables("gappy", body="""
    SELECT "Ticker", "Date", greatest(coalesce("Open", 1.0), 0.01) AS opened,
           greatest(coalesce("Close", 1.0), 0.01) AS closed FROM gappy"""))
def fn_floor_clip(spark, sf):
    return fx.gappy(spark, sf).select(
        "Ticker", "Date", s.floor_clip("Open", 1.0, 0.01).alias("opened"),
        s.floor_clip("Close", 1.0, 0.01).alias("closed"),
    )


@query("fn_case_bands", """
    SELECT event_id, c AS cluster, CASE WHEN c >= 3 THEN 'high' WHEN c >= 2 THEN 'medium' ELSE 'low' END AS risk_level,
           CASE WHEN c <= 1 THEN 'bullish' ELSE 'bearish' END AS market_sentiment
    FROM (SELECT event_id, event_id % 5 AS c FROM events)""")
def fn_case_bands(spark, sf):
    from candlewick.streaming.ticks import with_risk_labels

    df = fx.table(spark, sf, "events").select("event_id", (F.col("event_id") % 5).alias("cluster"))
    return with_risk_labels(df)


@query("fn_json", """
    SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS doc,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def fn_json(spark, sf):
    doc = F.to_json(F.struct("event_type", "user_id"))
    parsed = s.parse_json("props", "k bigint")
    return fx.table(spark, sf, "events").select("event_id", doc.alias("doc"), parsed["k"].alias("k"))


@query("fn_map_predictions", with_tables("bars", body="""
    SELECT "Ticker", "Date", "Date" + i AS day, round("Close" * sqrt(i), 2) AS value
    FROM bars, (SELECT unnest([1, 2, 3]) AS i)"""))
def fn_map_predictions(spark, sf):
    values = F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: F.col("Close") * F.sqrt(i))
    df = fx.bars(spark, sf).select("Ticker", "Date", s.predictions_map("Date", values).alias("predictions"))
    return s.explode_predictions(df)


@query("fn_metric_bands", with_tables("clusters", body="""
    SELECT "Ticker", "Date", CASE WHEN "RSI" > 70 THEN 'overbought' WHEN "RSI" < 30 THEN 'oversold'
                                  WHEN "RSI" IS NOT NULL THEN 'neutral' END AS rsi_status,
           CASE WHEN score >= 95 THEN 'green' WHEN score >= 80 THEN 'yellow' ELSE 'red' END AS score_status,
           CASE WHEN days >= 5 THEN 'yellow' WHEN days >= 2 THEN 'green' ELSE 'red' END AS days_status
    FROM (SELECT *, 70 + day("Date") AS score, month("Date") AS days FROM clusters)"""))
def fn_metric_bands(spark, sf):
    return fx.clusters(spark, sf).select(
        "Ticker", "Date", s.rsi_label("RSI").alias("rsi_status"),
        s.bands(70 + F.dayofmonth("Date"), SCORE_BANDS, SCORE_BELOW).alias("score_status"),
        s.bands(F.month("Date"), DAYS_BANDS, DAYS_BELOW).alias("days_status"),
    )
