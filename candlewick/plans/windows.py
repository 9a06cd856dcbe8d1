"""Window, sort and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions import windows as wf
from candlewick.operators import features as ft
from candlewick.operators import series as sr
from candlewick.operators import summary
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import FEATURES, TARGET, W, features_sql, round_sql, with_tables
from candlewick.plans.registry import query, rounded

POINTS = fx.POINTS
BAR = '"Ticker", "Date", "Open", "High", "Low", "Close", "Volume"'


def _frame(k: int, window: str = W) -> str:
    return f"({window} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def etl_sql(source: str) -> str:
    return f"""
        SELECT {BAR}, round(avg("Close") OVER {_frame(7)}, 6) AS "SMA_7",
               round(avg("Close") OVER {_frame(30)}, 6) AS "SMA_30",
               round(("High" - "Low") / nullif("Open", 0), 6) AS "Volatility",
               round("High" - "Low", 6) AS "Price_Range" FROM {source}"""


@query("bar_builder", with_tables("bars_many", body=f"SELECT {BAR} FROM bars_many"))
def bar_builder(spark, sf):
    return fx.bars_many(spark, sf)


@query("bar_builder_hourly", with_tables("bars_hourly", body=f"SELECT {BAR} FROM bars_hourly"))
def bar_builder_hourly(spark, sf):
    return fx.bars_hourly(spark, sf)


@query("etl_frame", with_tables("bars", body=etl_sql("bars")))
def etl_frame(spark, sf):
    return rounded(ft.etl_features(fx.bars(spark, sf)))


@query("etl_frame_many", with_tables("bars_many", body=etl_sql("bars_many")))
def etl_frame_many(spark, sf):
    return rounded(ft.etl_features(fx.bars_many(spark, sf)))


@query("sma_partial", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", round(avg("Close") OVER {_frame(7)}, 6) AS "SMA_7",
           round(avg("Close") OVER {_frame(30)}, 6) AS "SMA_30" FROM gappy"""))
def sma_partial(spark, sf):
    df = ft.sma(ft.sma(fx.gappy(spark, sf), "Close", 7), "Close", 30)
    return rounded(df.select("Ticker", "Date", "SMA_7", "SMA_30"))


def _full(k: int) -> str:
    return (
        f'round(CASE WHEN count("Close") OVER {_frame(k)} >= {k} THEN avg("Close") OVER {_frame(k)} END, 6) '
        f'AS "SMA_{k}"'
    )


@query("sma_full", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", {_full(5)}, {_full(7)}, {_full(20)} FROM gappy"""))
def sma_full(spark, sf):
    df = fx.gappy(spark, sf)
    for k in (5, 7, 20):
        df = ft.sma(df, "Close", k, min_periods=k)
    return rounded(df.select("Ticker", "Date", "SMA_5", "SMA_7", "SMA_20"))


@query("pct_change", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", {round_sql(["Returns_1d", "Returns_5d", "Volume_Change"])},
           round("Returns_1d" * 100, 6) AS "Returns_Pct" FROM ({features_sql("gappy")})"""))
def pct_change(spark, sf):
    df = fx.gappy(spark, sf)
    df = ft.pct_change(df, "Close", 1, name="Returns_1d")
    df = ft.pct_change(df, "Close", 5, name="Returns_5d")
    df = ft.pct_change(df, "Volume", 1, name="Volume_Change")
    df = ft.pct_change(df, "Close", 1, scale=100, name="Returns_Pct")
    return rounded(df.select("Ticker", "Date", "Returns_1d", "Returns_5d", "Volume_Change", "Returns_Pct"))


@query("rolling_std", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", round("Volatility_5d", 6) AS "Volatility_5d" FROM ({features_sql("gappy")})"""))
def rolling_std(spark, sf):
    df = ft.pct_change(fx.gappy(spark, sf), "Close", 1, name="Returns_1d")
    df = ft.rolling_std(df, "Returns_1d", 5, name="Volatility_5d")
    return rounded(df.select("Ticker", "Date", "Volatility_5d"))


@query("lags", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", lag("Close", 1) OVER ({W}) AS "Lag_1_Close",
           lag("Close", 2) OVER ({W}) AS "Lag_2_Close", lag("Close", 3) OVER ({W}) AS "Lag_3_Close" FROM gappy"""))
def lags(spark, sf):
    df = ft.lags(fx.gappy(spark, sf), "Close", [1, 2, 3])
    return df.select("Ticker", "Date", "Lag_1_Close", "Lag_2_Close", "Lag_3_Close")


@query("sma_cross", with_tables("features", body=f"""
    SELECT "Ticker", "Date", round("SMA_Cross", 6) AS "SMA_Cross",
           CASE WHEN sign("SMA_Cross") <> sign(lag("SMA_Cross") OVER ({W})) THEN CAST(sign("SMA_Cross") AS INTEGER)
                ELSE 0 END AS "Cross_Signal" FROM features"""))
def sma_cross(spark, sf):
    return rounded(ft.sma_cross(fx.bars(spark, sf)).select("Ticker", "Date", "SMA_Cross", "Cross_Signal"))


@query("rsi", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", round("RSI", 6) AS "RSI" FROM ({features_sql("gappy")})"""))
def rsi(spark, sf):
    return rounded(ft.rsi(fx.gappy(spark, sf)).select("Ticker", "Date", "RSI"))


@query("targets", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", "Target_Up", round("Target_Change", 6) AS "Target_Change"
    FROM ({features_sql("gappy")})"""))
def targets(spark, sf):
    return rounded(ft.targets(fx.gappy(spark, sf)).select("Ticker", "Date", "Target_Up", "Target_Change"))


def _feature_frame_sql(source: str) -> str:
    return f"""
        SELECT {BAR}, {round_sql(FEATURES)}, "Target_Up" FROM ({features_sql(source)})
        WHERE "Returns_1d" IS NOT NULL AND "Volatility_5d" IS NOT NULL"""


@query("feature_frame", with_tables("gappy", body=_feature_frame_sql("gappy")))
def feature_frame(spark, sf):
    return rounded(ft.ml_features(fx.gappy(spark, sf)))


@query("feature_frame_many", with_tables("bars_many", body=_feature_frame_sql("bars_many")))
def feature_frame_many(spark, sf):
    return rounded(ft.ml_features(fx.bars_many(spark, sf)))


_P = "PARTITION BY ticker ORDER BY ts, event_id"


@query("point_features", with_tables("points", body=f"""
    SELECT ticker, ts, event_id,
           round(value / nullif(lag(value, 1) OVER ({_P}), 0) - 1, 6) AS change_1,
           round(avg(value) OVER {_frame(30, _P)}, 6) AS mean_30,
           round(CASE WHEN count(value) OVER {_frame(20, _P)} >= 20
                      THEN stddev_samp(value) OVER {_frame(20, _P)} END, 6) AS std_20
    FROM points"""))
def point_features(spark, sf):
    """Rolling features over raw points: few hot series, cut into blocks that overlap by one frame."""
    def compute(rows, w):
        return rows.withColumns({
            "change_1": wf.change_over("_v", 1, w),
            "mean_30": wf.sma("value", 30, w),
            "std_20": wf.rolling_std("value", 20, w),
        })

    out = sr.in_blocks(fx.points(spark, sf), POINTS, compute, before=30, fill={"_v": F.col("value")})
    return rounded(out.select("ticker", "ts", "event_id", "change_1", "mean_30", "std_20"))


@query("prev_close_change", with_tables("bars", body=f"""
    SELECT "Ticker", "Date" AS as_of, "Close" AS latest, coalesce(prev, "Close") AS previous,
           round("Close" - coalesce(prev, "Close"), 6) AS change,
           round(("Close" - coalesce(prev, "Close")) / coalesce(prev, "Close") * 100, 6) AS change_pct
    FROM (SELECT *, lag("Close") OVER ({W}) AS prev,
                 row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM bars)
    WHERE rn = 1"""))
def prev_close_change(spark, sf):
    return rounded(sr.latest_change(fx.bars(spark, sf)))


_ABOVE = f'coalesce("Close" >= {TARGET}, FALSE)'


@query("max_streak", with_tables("gappy", body=f"""
    SELECT "Ticker", max(run) AS max_streak, max(run) >= 3 AS confirmed FROM (
        SELECT "Ticker", island, CAST(sum(CAST(holds AS INTEGER)) AS BIGINT) AS run FROM (
            SELECT "Ticker", {_ABOVE} AS holds,
                   sum(CAST(NOT {_ABOVE} AS INTEGER)) OVER ({W} ROWS UNBOUNDED PRECEDING) AS island FROM gappy)
        GROUP BY 1, 2) GROUP BY 1"""))
def max_streak(spark, sf):
    return sr.longest_streak(fx.gappy(spark, sf), F.col("Close") >= TARGET, min_run=3)


@query("max_streak_points", with_tables("points", body=f"""
    SELECT ticker, max(run) AS max_streak, max(run) >= 4 AS confirmed FROM (
        SELECT ticker, island, CAST(sum(CAST(holds AS INTEGER)) AS BIGINT) AS run FROM (
            SELECT ticker, value >= 10 AS holds,
                   sum(CAST(value < 10 AS INTEGER)) OVER ({_P} ROWS UNBOUNDED PRECEDING) AS island FROM points)
        GROUP BY 1, 2) GROUP BY 1"""))
def max_streak_points(spark, sf):
    return sr.longest_streak(fx.points(spark, sf), F.col("value") >= 10, POINTS, 4)


@query("trailing_streak", with_tables("gappy", body=f"""
    SELECT "Ticker", CAST(coalesce(min(CASE WHEN NOT holds THEN rn END) - 1, count(*)) AS BIGINT) AS streak FROM (
        SELECT "Ticker", {_ABOVE} AS holds,
               row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM gappy)
    WHERE rn <= 20 GROUP BY 1"""))
def trailing_streak(spark, sf):
    return sr.trailing_streak(fx.gappy(spark, sf), F.col("Close") >= TARGET)


@query("sequence_windows", with_tables("bars", body=f"""
    SELECT "Ticker", "Date", lags[1] AS oldest, lags[60] AS newest, round(list_avg(lags), 4) AS mean,
           "Close" AS label
    FROM (SELECT *, list("Close") OVER ({W} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS lags FROM bars)
    WHERE len(lags) = 60"""))
def sequence_windows(spark, sf):
    df = sr.sequences(fx.bars(spark, sf))
    mean = F.aggregate("lags", F.lit(0.0), lambda a, x: a + x) / F.size("lags")
    return df.select(
        "Ticker", "Date", F.element_at("lags", 1).alias("oldest"), F.element_at("lags", -1).alias("newest"),
        F.round(mean, 4).alias("mean"), "label",
    )


@query("sequence_windows_points", with_tables("points", body=f"""
    SELECT ticker, ts, event_id, lags[1] AS oldest, lags[60] AS newest, value AS label
    FROM (SELECT *, list(value) OVER ({_P} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS lags FROM points)
    WHERE len(lags) = 60"""))
def sequence_windows_points(spark, sf):
    df = sr.sequences(fx.points(spark, sf), "value", 60, POINTS)
    return df.select(
        "ticker", "ts", "event_id", F.element_at("lags", 1).alias("oldest"),
        F.element_at("lags", -1).alias("newest"), "label",
    )


@query("chrono_split", with_tables("bars", body=f"""
    SELECT "Ticker", "Date", "Close",
           CASE WHEN row_number() OVER ({W}) <= floor(0.8 * count(*) OVER (PARTITION BY "Ticker"))
                THEN 'train' ELSE 'test' END AS part FROM bars"""))
def chrono_split(spark, sf):
    return sr.chrono_split(fx.bars(spark, sf).select("Ticker", "Date", "Close"))


@query("chrono_split_points", with_tables("points", body=f"""
    SELECT ticker, ts, event_id, value,
           CASE WHEN row_number() OVER ({_P}) <= floor(0.8 * count(*) OVER (PARTITION BY ticker))
                THEN 'train' ELSE 'test' END AS part FROM points"""))
def chrono_split_points(spark, sf):
    return sr.chrono_split(fx.points(spark, sf), 0.8, POINTS)


@query("sustained_condition", with_tables("logs", body="""
    SELECT pipeline, min("@timestamp") AS started, max("@timestamp") AS ended, CAST(count(*) AS BIGINT) AS n_points
    FROM (SELECT *, sum(CAST(severity = 'FATAL' AS INTEGER)) OVER (
              PARTITION BY pipeline ORDER BY "@timestamp", run_id ROWS UNBOUNDED PRECEDING) AS island FROM logs)
    WHERE severity <> 'FATAL' GROUP BY pipeline, island
    HAVING max("@timestamp") - min("@timestamp") >= INTERVAL 5 MINUTE"""))
def sustained_condition(spark, sf):
    logs = fx.logs(spark, sf).select("pipeline", "@timestamp", "run_id", "severity")
    series = sr.Series(("pipeline",), "@timestamp", ("run_id",), sr.Split("minute"))
    return sr.sustained(logs, F.col("severity") != "FATAL", "5 minutes", series)


@query("sort_series", with_tables("bars", body=f"SELECT {BAR} FROM bars"))
def sort_series(spark, sf):
    return summary.sort_series(fx.bars(spark, sf))


@query("head_preview", with_tables("bars", body=f'SELECT {BAR} FROM bars ORDER BY "Date", "Ticker" LIMIT 5'))
def head_preview(spark, sf):
    return summary.preview(fx.bars(spark, sf), 5, ["Date", "Ticker"])


@query("tail_n", with_tables("bars_many", body=f"""
    SELECT {BAR}, CAST(rn AS INTEGER) AS position FROM (
        SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM bars_many)
    WHERE rn <= 5"""))
def tail_n(spark, sf):
    return summary.tail_n(fx.bars_many(spark, sf), 5)


@query("newest_doc", """
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def newest_doc(spark, sf):
    docs = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return summary.newest(docs, "o_orderdate", ["o_orderkey"])
