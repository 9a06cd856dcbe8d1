"""Aggregations, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import dedup, joins, summary
from candlewick.operators.filters import since
from candlewick.operators.runs import search_runs
from candlewick.operators.series import min_rows
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded

BAR = '"Ticker", "Date", "Open", "High", "Low", "Close", "Volume"'


@query("cluster_summary", with_tables("clusters", body="""
    SELECT "Cluster", round(avg("Close"), 4) AS "mean_Close", round(avg("Volume"), 4) AS "mean_Volume",
           round(avg("Returns_1d"), 4) AS "mean_Returns_1d"
    FROM clusters WHERE "Cluster" IS NOT NULL GROUP BY 1"""))
def cluster_summary(spark, sf):
    return rounded(summary.cluster_summary(fx.clusters(spark, sf)), 4)


@query("cluster_distribution", with_tables("clusters", body="""
    SELECT "Cluster", CAST(count(*) AS BIGINT) AS n FROM clusters WHERE "Cluster" IS NOT NULL GROUP BY 1"""))
def cluster_distribution(spark, sf):
    return summary.value_counts(fx.clusters(spark, sf), "Cluster")


@query("cluster_bullish_pct", with_tables("clusters", body="""
    SELECT "Cluster", CAST(count(*) AS BIGINT) AS n,
           round(avg(CASE WHEN "Returns_1d" > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_up
    FROM clusters WHERE "Cluster" IS NOT NULL GROUP BY 1"""))
def cluster_bullish_pct(spark, sf):
    return rounded(summary.pct_positive(fx.clusters(spark, sf)))


def _last(c: str) -> str:
    return f'arg_max("{c}", CASE WHEN "{c}" IS NOT NULL THEN "Date" END) AS "{c}"'


@query("latest_per_symbol", with_tables("gappy", body=f"""
    SELECT *, round("Close" - "Open", 6) AS "Change",
           round(("Close" - "Open") / nullif("Open", 0) * 100, 6) AS "Change_Pct" FROM (
        SELECT "Ticker", max("Date") AS "Date", {", ".join(_last(c) for c in
               ("Open", "High", "Low", "Close", "Volume"))} FROM gappy GROUP BY 1)"""))
def latest_per_symbol(spark, sf):
    return rounded(summary.latest_per_key(fx.gappy(spark, sf)))


@query("symbol_inventory", with_tables("bars_many", body="""
    SELECT "Ticker", CAST(count(*) AS BIGINT) AS n_rows, min("Date") AS "first", max("Date") AS "last"
    FROM bars_many GROUP BY 1"""))
def symbol_inventory(spark, sf):
    return summary.describe_series(fx.bars_many(spark, sf))


@query("symbol_inventory_overall", with_tables("bars_many", body="""
    SELECT CAST(count(DISTINCT "Ticker") AS BIGINT) AS n_symbols, CAST(count(*) AS BIGINT) AS n_rows,
           min("Date") AS "first", max("Date") AS "last" FROM bars_many"""))
def symbol_inventory_overall(spark, sf):
    return summary.describe_overall(fx.bars_many(spark, sf))


@query("overall_extrema", with_tables("market", body="""
    SELECT "Ticker", arg_max("Close", "Date") AS latest_close, max("Close") AS max_close FROM market GROUP BY 1"""))
def overall_extrema(spark, sf):
    return summary.overall_extrema(fx.market(spark, sf))


@query("severity_counts", with_tables("logs", body="""
    SELECT severity, pipeline, CAST(count(*) AS BIGINT) AS n FROM logs
    WHERE "@timestamp" >= (SELECT max("@timestamp") FROM logs) - INTERVAL 1 DAY GROUP BY 1, 2"""))
def severity_counts(spark, sf):
    recent = since(fx.logs(spark, sf), "@timestamp", "1 day")
    return summary.severity_counts(recent, ["severity", "pipeline"])


@query("status_totals", with_tables("metrics", body="""
    SELECT sum(value) AS total FROM metrics WHERE measurement = 'purchase' AND status = 'success' AND field = 'k'"""))
def status_totals(spark, sf):
    points = fx.metrics(spark, sf).filter("field = 'k'")
    return summary.metric_sum(points, "purchase", {"status": "success"})


@query("last_value_metric", with_tables("metrics", body="""
    SELECT measurement, field, last(value ORDER BY ts, event_id) AS value, max(ts) AS ts
    FROM metrics GROUP BY 1, 2"""))
def last_value_metric(spark, sf):
    order = fx.packed_order("ts", "event_id")
    return summary.last_point(fx.metrics(spark, sf), order=order)


@query("metric_pivot", with_tables("metrics", body="""
    SELECT measurement, ts, max(CASE WHEN field = 'k' THEN value END) AS k,
           max(CASE WHEN field = 'value' THEN value END) AS value FROM metrics GROUP BY 1, 2"""))
def metric_pivot(spark, sf):
    return summary.pivot_metrics(fx.metrics(spark, sf), ["k", "value"], ["measurement", "ts"], order="ts")


@query("mean_return", with_tables("features", body="""
    SELECT "Ticker", round(avg("Returns_1d"), 6) AS mean_return FROM features GROUP BY 1"""))
def mean_return(spark, sf):
    return rounded(summary.mean_return(fx.clusters(spark, sf)))


@query("alert_grouping", with_tables("alerts", body="""
    SELECT alertname, job, CAST(count(*) AS BIGINT) AS n_alerts, min(ts) AS first_at, max(ts) AS last_at
    FROM alerts GROUP BY 1, 2"""))
def alert_grouping(spark, sf):
    return summary.group_alerts(fx.alerts(spark, sf))


@query("cluster_mean_lookup", with_tables("clusters", body="""
    SELECT "Ticker", "Date", "Close", "Cluster", round(m, 4) AS "Cluster_Avg_Close",
           round(v, 4) AS "Cluster_Avg_Volatility", round("Close" - m, 4) AS "Price_vs_Cluster"
    FROM clusters LEFT JOIN (SELECT "Cluster" AS c, avg("Close") AS m, avg("Volatility_5d") AS v FROM clusters
                             WHERE "Cluster" IS NOT NULL GROUP BY 1) ON "Cluster" = c"""))
def cluster_mean_lookup(spark, sf):
    df = joins.enrich_with_cluster_means(fx.clusters(spark, sf))
    return rounded(df.select(
        "Ticker", "Date", "Close", "Cluster", F.round("Cluster_Avg_Close", 4).alias("Cluster_Avg_Close"),
        F.round("Cluster_Avg_Volatility", 4).alias("Cluster_Avg_Volatility"),
        F.round("Price_vs_Cluster", 4).alias("Price_vs_Cluster"),
    ))


@query("symbol_name_dim", with_tables("bars", body="""
    SELECT "Ticker", "Date", "Close", CASE "Ticker" WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
           WHEN '3-MEDIUM' THEN 'Medium' END AS "Nama_Saham" FROM bars"""))
def symbol_name_dim(spark, sf):
    return joins.with_symbol_name(fx.bars(spark, sf).select("Ticker", "Date", "Close"), fx.NAMES)


@query("symbol_name_table", with_tables("bars_many", body="""
    SELECT "Ticker", "Date", "Close", p_name AS "Nama_Saham"
    FROM bars_many LEFT JOIN part ON "Ticker" = CAST(p_partkey AS VARCHAR)"""))
def symbol_name_table(spark, sf):
    names = fx.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Ticker"), F.col("p_name").alias("Nama_Saham")
    )
    bars = fx.bars_many(spark, sf).select("Ticker", "Date", "Close")
    return joins.with_symbol_name(bars, names)


@query("alert_inhibition", with_tables("alerts", body="""
    SELECT event_id, alertname, job, severity, ts FROM alerts a WHERE NOT (severity = 'warning' AND EXISTS (
        SELECT 1 FROM alerts c WHERE c.severity = 'critical' AND c.alertname = a.alertname AND c.job = a.job))"""))
def alert_inhibition(spark, sf):
    return joins.inhibit(fx.alerts(spark, sf))


@query("union_files", with_tables("bars", "market", body="""
    SELECT "Ticker", "Date", "Close", "Volume" FROM bars
    UNION ALL SELECT "Ticker", "Date", "Close", NULL FROM market"""))
def union_files(spark, sf):
    left = fx.bars(spark, sf).select("Ticker", "Date", "Close", "Volume")
    return dedup.union_frames(left, fx.market(spark, sf).select("Date", "Ticker", "Close"))


@query("dedup_key_newest", """
    SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                               ORDER BY l_orderkey DESC, l_linenumber DESC) = 1""")
def dedup_key_newest(spark, sf):
    items = fx.table(spark, sf, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice",
        F.to_date("l_shipdate").alias("day"),
    )
    return dedup.dedup_newest(items, ["l_partkey", "day"], "l_orderkey", ["l_linenumber"]).drop("day")


@query("duplicate_count", with_tables("dirty", body=f"""
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
        SELECT {BAR}, count(*) AS n FROM dirty GROUP BY ALL)"""))
def duplicate_count(spark, sf):
    tagged = fx.dirty(spark, sf).withColumn("_source_file", F.lit("one.csv"))
    return dedup.duplicate_count(tagged)


@query("feature_store_min_rows", with_tables("bars_many", body=f"""
    SELECT {BAR} FROM bars_many WHERE "Ticker" IN (
        SELECT "Ticker" FROM bars_many GROUP BY 1 HAVING count(*) >= 25)"""))
def feature_store_min_rows(spark, sf):
    return min_rows(fx.bars_many(spark, sf), 25)


@query("search_runs", """
    SELECT CAST(user_id AS VARCHAR) AS run_id, round(avg(value), 6) AS val_loss, CAST(count(*) AS BIGINT) AS epochs
    FROM events GROUP BY user_id""")
def search_runs_by_loss(spark, sf):
    per_user = fx.table(spark, sf, "events").groupBy("user_id").agg(
        F.round(F.avg("value"), 6).alias("loss"), F.count(F.lit(1)).alias("n")
    )
    runs = per_user.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.create_map(F.lit("val_loss"), F.col("loss"), F.lit("epochs"), F.col("n").cast("double")).alias("metrics"),
    )
    ordered = search_runs(runs, "val_loss")
    return ordered.select(
        "run_id", F.col("metrics")["val_loss"].alias("val_loss"),
        F.col("metrics")["epochs"].cast("long").alias("epochs"),
    )
