"""Clustering and forecasting queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.operators import cluster, forecast, runs
from candlewick.operators.features import etl_features, ml_features
from candlewick.operators.series import BARS
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import TARGET, features_sql, with_tables
from candlewick.plans.registry import query, rounded
from candlewick.plans.streams import ONCE, _drain, _payload, _stream
from candlewick.plans.windows import etl_sql
from candlewick.schemas import CLUSTER_FEATURES, ETL_CLUSTER_FEATURES
from candlewick.session import scratch_path
from candlewick.sources.files import latest_files
from candlewick.sources.sinks import write_features, write_text
from candlewick.streaming import ticks as tk

# Lag weights of the fixed forecaster: the last three values and the oldest one.
WEIGHTS = (0.1,) + (0.0,) * 56 + (0.1, 0.2, 0.5)
INTERCEPT = 1_000.0


_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in CLUSTER_FEATURES)
_USED = f'"Returns_1d" IS NOT NULL AND "Volatility_5d" IS NOT NULL AND {_COMPLETE}'


def _audit(model, features):
    """Facts that SQL can state for any trained model of four clusters."""
    found = cluster.audit_clusters(model, features)
    return found.select(
        F.col("cluster").cast("long").alias("cluster"), "n_misplaced",
        (F.col("off_mean") <= cluster.SETTLED).alias("centre_is_mean"),
        F.sum("n").over(Window.partitionBy()).alias("n_samples"),
    )


_AUDIT_SQL = """
    SELECT cluster, CAST(0 AS BIGINT) AS n_misplaced, TRUE AS centre_is_mean, CAST(n AS BIGINT) AS n_samples
    FROM unnest(range(4)) AS c(cluster), (SELECT count(*) AS n FROM {rows})"""


@query("kmeans_train", with_tables("features", body=_AUDIT_SQL.format(rows=f"features WHERE {_USED}")))
def kmeans_train(spark, sf):
    """The trained model's clusters: every row is with its nearest centre, every centre the mean of its rows."""
    features = ml_features(fx.bars(spark, sf))
    return _audit(cluster.train_clusters(features), features)


_ETL_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in ETL_CLUSTER_FEATURES)


@query("kmeans_train_etl", with_tables("bars", body=_AUDIT_SQL.format(
    rows=f"({etl_sql('bars')}) WHERE {_ETL_COMPLETE}")))
def kmeans_train_etl(spark, sf):
    """The variant on the ETL features."""
    features = etl_features(fx.bars(spark, sf))
    return _audit(cluster.train_clusters(features, ETL_CLUSTER_FEATURES), features)


@query("kmeans_metrics", with_tables("features", body=f"""
    SELECT CAST(4 AS INTEGER) AS k, count(*) AS n_samples, TRUE AS inertia_is_cost, count(*) AS in_clusters,
           TRUE AS silhouette_in_range, CAST({len(CLUSTER_FEATURES)} AS INTEGER) AS n_features
    FROM features WHERE {_USED}"""))
def kmeans_metrics(spark, sf):
    """The metrics of a model, with its inertia against the summed distances of an audit."""
    features = ml_features(fx.bars(spark, sf))
    model = cluster.train_clusters(features)
    found = cluster.cluster_metrics(model, features)
    cost = cluster.audit_clusters(model, features).agg(F.sum("cost").alias("cost"))
    n = found["n_samples"]
    ratio = F.col("cost") * n / max(n - 1, 1) / found["inertia"]
    return cost.select(
        F.lit(found["k"]).alias("k"), F.lit(n).cast("long").alias("n_samples"),
        F.abs(ratio - 1).__lt__(1e-3).alias("inertia_is_cost"),
        F.lit(sum(found["sizes"].values())).cast("long").alias("in_clusters"),
        F.lit(found["silhouette"]).between(-1, 1).alias("silhouette_in_range"),
        F.lit(len(found["feature_names"])).alias("n_features"),
    )


@query("kmeans_sweep", with_tables("features", body=f"""
    SELECT CAST(k AS INTEGER) AS k, n_samples, TRUE AS costs_less, TRUE AS silhouette_in_range
    FROM unnest([3, 4, 5]) AS s(k), (SELECT count(*) AS n_samples FROM features WHERE {_USED})"""))
def kmeans_sweep(spark, sf):
    """One row per k; more clusters cost less."""
    rows = cluster.sweep(ml_features(fx.bars(spark, sf)), (3, 4, 5))
    before = F.lag("inertia").over(Window.orderBy("k"))
    return rows.select(
        "k", "n_samples", F.coalesce(F.col("inertia") < before, F.lit(True)).alias("costs_less"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


@query("prediction_backfill", with_tables("gappy", body=f"""
    SELECT "Ticker", "Date", "Close", {_COMPLETE} AS scored, CASE WHEN {_COMPLETE} THEN TRUE END AS nearest,
           TRUE AS several FROM ({features_sql("gappy")})
    WHERE "Returns_1d" IS NOT NULL AND "Volatility_5d" IS NOT NULL"""))
def prediction_backfill(spark, sf):
    """Every row of a gappy table, scored where it is complete, by the model of the full one: several clusters
    are in use, and each row has that of its nearest centre, computed from the model's numbers."""
    model = cluster.train_clusters(ml_features(fx.bars(spark, sf)))
    features = ml_features(fx.gappy(spark, sf))
    scored = cluster.predict_into(features, model)
    used = scored.agg(F.count_distinct("Cluster").alias("n_clusters"))
    return scored.select(
        "Ticker", "Date", "Close", F.coalesce(F.col("Cluster").between(0, 3), F.lit(False)).alias("scored"),
        (F.col("Cluster") == cluster.nearest_centre(model)).alias("nearest"), F.lit(used.first()[0] > 1).alias("several"),
    )


@query("batch_score", with_tables("features", body=f"""
    SELECT "Ticker", "Date", "Close", round("RSI", 6) AS "RSI", {_COMPLETE} AS scored,
           CASE WHEN {_COMPLETE} THEN CAST(0 AS DOUBLE) END AS off, CASE WHEN {_COMPLETE} THEN TRUE END AS nearest FROM features
    WHERE "Returns_1d" IS NOT NULL AND "Volatility_5d" IS NOT NULL"""))
def batch_score(spark, sf):
    """Newest model, newest feature runs, newest copy of each row, enriched and stored.

    Cluster numbers are the model's own, so the result shows what must hold for any of them: one row
    per bar, scored where complete, ``nearest`` whether its number is that of its nearest centre, ``off`` how
    far mean and difference are from a group-by over what was stored.
    """
    store, folder = scratch_path(spark, "store"), scratch_path(spark, "feature-runs")
    features = ml_features(fx.bars(spark, sf))
    for run in ("first", "second"):
        write_features(features, folder, stamp=run)
    training = latest_files(spark, folder, 1, by="run")
    model = cluster.train_clusters(training)
    order = cluster.volatility_order(cluster.predict_into(training, model), 4)
    runs.save_model(model, store, "clusters", {"k": 4, "order": ",".join(map(str, order))}, {})
    loaded, card = runs.load_latest(spark, store, "clusters")
    order = [int(c) for c in card["params"]["order"].split(",")]
    newest = latest_files(spark, folder, 5, by="run")
    scored = cluster.score_batch(newest, loaded, recency="_source_modified", order=order)
    write_features(scored.drop("_source_file", "_source_modified"), f"{store}/predictions")
    stored = spark.read.parquet(f"{store}/predictions")
    means = stored.groupBy("Cluster").agg(F.avg("Close").alias("mean"))
    off = F.abs(F.col("Cluster_Avg_Close") - F.col("mean")) + F.abs(F.col("Price_vs_Cluster") - (F.col("Close") - F.col("mean")))
    number = F.get(F.array(*map(F.lit, order)), cluster.nearest_centre(loaded))
    return rounded(stored.join(means, "Cluster", "left").select(
        "Ticker", "Date", "Close", "RSI", F.col("Cluster").isNotNull().alias("scored"), off.alias("off"),
        (F.col("Cluster") == number).alias("nearest"),
    ))


@query("model_store", with_tables("features", body=f"""
    SELECT count(*) AS n_scored, count(*) AS n_samples, CAST(0 AS BIGINT) AS n_changed FROM features WHERE {_USED}"""))
def model_store(spark, sf):
    """A saved model and its run card, found again through the run table; it scores as it did before."""
    store = scratch_path(spark, "models")
    features = ml_features(fx.bars(spark, sf))
    model = cluster.train_clusters(features)
    found = cluster.cluster_metrics(model, features)
    runs.save_model(model, store, "clusters", {"k": 4}, {"n_samples": found["n_samples"]})
    loaded, card = runs.load_latest(spark, store, "clusters")
    again = cluster.predict_into(cluster.predict_into(features, model, "before"), loaded, "after")
    return again.agg(
        F.count("after").alias("n_scored"),
        F.lit(card["metrics"]["n_samples"]).cast("long").alias("n_samples"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("n_changed"),
    )


@query("run_table", with_tables("runs", body="""
    SELECT run_id, pipeline, status, CAST(duration_ms AS DOUBLE) AS duration_ms FROM runs
    WHERE status = 'completed'"""))
def run_table(spark, sf):
    """Runs are appended to the run table, then searched."""
    rows = fx.runs(spark, sf).select(
        "run_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "pipeline", "status",
        F.create_map(F.lit("source"), F.lit("events")).alias("params"),
        F.create_map(F.lit("duration_ms"), F.col("duration_ms").cast("double")).alias("metrics"),
        F.lit(None).cast("string").alias("artifact"),
    )
    path = scratch_path(spark, "runs")
    runs.append_runs(rows, path)
    done = runs.read_runs(spark, path).filter("status = 'completed'")
    return runs.search_runs(done, "duration_ms", ascending=False).select(
        "run_id", "pipeline", "status", F.col("metrics")["duration_ms"].alias("duration_ms")
    )


_HIDDEN = """"Ticker" = '2-HIGH' AND "Date" > DATE '1998-06-01'"""


@query("index_analysis", with_tables("clusters", body=f"""
    SELECT "Ticker", arg_max("Close", "Date") AS latest_close, arg_max_null("Cluster", "Date") AS latest_cluster,
           CAST(count(*) FILTER ("Cluster" = 0) AS BIGINT) AS n0, CAST(count(*) FILTER ("Cluster" = 1) AS BIGINT) AS n1,
           CAST(count(*) FILTER ("Cluster" = 2) AS BIGINT) AS n2, CAST(count(*) FILTER ("Cluster" = 3) AS BIGINT) AS n3,
           max("Close") FILTER (rn = 5) AS fifth_last, max("Close") FILTER (rn = 2) AS previous
    FROM (SELECT * REPLACE (CASE WHEN NOT ({_HIDDEN}) THEN "Cluster" END AS "Cluster"),
                 row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM clusters)
    GROUP BY 1"""))
def index_analysis(spark, sf):
    """One series has no cluster in its newest rows."""
    hidden = (F.col("Ticker") == "2-HIGH") & (F.col("Date") > F.lit("1998-06-01").cast("date"))
    rows = fx.clusters(spark, sf).withColumn("Cluster", F.when(~hidden, F.col("Cluster")))
    found = cluster.series_analysis(rows)
    counted = [F.coalesce(F.col("distribution")[i], F.lit(0)).alias(f"n{i}") for i in range(4)]
    return found.select(
        "Ticker", "latest_close", "latest_cluster", *counted,
        F.col("recent_closes")[0].alias("fifth_last"), F.col("recent_closes")[3].alias("previous"),
    )


_DAYS = f"""
    SELECT "Ticker", latest_close, round(mean_return, 6) AS mean_return, round({TARGET} - latest_close, 6) AS gap,
           CASE WHEN mean_return > 0 AND {TARGET} - latest_close > 0 THEN
               greatest(1, CAST(floor(({TARGET} - latest_close) / (latest_close * mean_return)) AS BIGINT)) END AS days,
           CASE WHEN {TARGET} - latest_close <= 0 THEN 'reached' WHEN mean_return > 0 THEN 'rising'
                ELSE 'not rising' END AS status"""


@query("days_to_target", with_tables("features", "market_features", body=f"""{_DAYS} FROM (
    SELECT "Ticker", arg_max("Close", "Date") AS latest_close, avg("Returns_1d") AS mean_return
    FROM (SELECT * FROM features UNION ALL SELECT * FROM market_features) GROUP BY 1)"""))
def days_to_target(spark, sf):
    rows = ml_features(
        fx.bars(spark, sf).unionByName(fx.market(spark, sf)), BARS, keep_incomplete=True
    )
    return rounded(forecast.days_to_target(rows, TARGET))


@query("lag_regression_forecast")
def lag_regression_forecast(spark, sf):
    """The lag model of the index series and its errors on the newest fifth."""
    model = forecast.train_forecaster(fx.market(spark, sf))
    row = (model.n, model.intercept, list(model.coefficients), model.metrics["val_loss"], model.metrics["val_mae"])
    return spark.createDataFrame(
        [row], "seq_len int, intercept double, coefficients array<double>, val_loss double, val_mae double"
    )


@query("lag_regression_one", with_tables("market", body="""
    , pairs AS (
        SELECT x, y, row_number() OVER (ORDER BY "Date") <= floor(0.8 * count(*) OVER ()) AS train
        FROM (SELECT "Date", "Close" AS y, lag("Close") OVER (ORDER BY "Date") AS x FROM market) WHERE x IS NOT NULL),
    fit AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs WHERE train)
    SELECT CAST(1 AS INTEGER) AS seq_len, round(a, 6) AS coefficient, round(b, 3) AS intercept,
           (SELECT round(avg((a * x + b - y) * (a * x + b - y)) / 1000000, 3) FROM pairs WHERE NOT train) AS val_loss,
           (SELECT round(avg(abs(a * x + b - y)), 3) FROM pairs WHERE NOT train) AS val_mae FROM fit"""))
def lag_regression_one(spark, sf):
    """The lag model with one lag and no penalty, which SQL can fit as well; the loss in millions."""
    model = forecast.train_forecaster(fx.market(spark, sf), n=1, ridge=0.0)
    row = (1, model.coefficients[0], model.intercept, model.metrics["val_loss"] / 1e6, model.metrics["val_mae"])
    found = spark.createDataFrame([row], "seq_len int, coefficient double, intercept double, val_loss double, val_mae double")
    return found.select("seq_len", F.round("coefficient", 6).alias("coefficient"), *[F.round(c, 3).alias(c) for c in ("intercept", "val_loss", "val_mae")])


_STEP = f"0.1 * h[-60] + 0.1 * h[-3] + 0.2 * h[-2] + 0.5 * h[-1] + {INTERCEPT}"
_FORECAST = f"""
    recent AS (
        SELECT "Ticker", max("Date") AS last_date, arg_max("Close", "Date") AS latest_close,
               list("Close" ORDER BY "Date") AS h
        FROM (SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS rn FROM both_bars)
        WHERE rn <= 60 GROUP BY 1 HAVING count(*) = 60),
    steps AS (
        SELECT "Ticker", last_date, latest_close, h, 0 AS step, CAST(NULL AS DOUBLE) AS value FROM recent
        UNION ALL
        SELECT "Ticker", last_date, latest_close, list_append(h, {_STEP}), step + 1, {_STEP} FROM steps WHERE step < 7)"""
_BOTH = "both_bars AS (SELECT * FROM bars UNION ALL SELECT * FROM market)"


def _forecast_sql(body: str) -> str:
    return with_tables("bars", "market", body=f", {_BOTH}, {_FORECAST} {body}").replace("WITH bars", "WITH RECURSIVE bars", 1)


def _forecasts(spark, sf):
    both = fx.bars(spark, sf).unionByName(fx.market(spark, sf))
    return forecast.forecast(both, WEIGHTS, INTERCEPT)


@query("recursive_forecast", _forecast_sql("""
    SELECT "Ticker", latest_close, step, last_date + step AS day, round(value, 2) AS predicted FROM steps
    WHERE step > 0"""))
def recursive_forecast(spark, sf):
    return _forecasts(spark, sf)


@query("first_hit", _forecast_sql(f"""
    SELECT "Ticker", min(step) FILTER (round(value, 2) >= {TARGET}) AS first_step,
           CASE WHEN min(step) FILTER (round(value, 2) >= {TARGET}) IS NULL THEN 'not reached'
                WHEN min(step) FILTER (round(value, 2) >= {TARGET}) = 1 THEN 'already' ELSE 'reached' END AS status
    FROM steps WHERE step > 0 GROUP BY 1"""))
def first_hit(spark, sf):
    return forecast.first_hit(_forecasts(spark, sf), TARGET)


@query("stream_predict", with_tables("ticks", body="""
    SELECT ticker, CAST(count(*) AS BIGINT) AS n_scored, CAST(count(*) AS BIGINT) AS n_sent,
           CAST(0 AS BIGINT) AS n_mislabeled, CAST(0 AS BIGINT) AS n_misplaced FROM ticks GROUP BY 1"""))
def stream_predict(spark, sf):
    """Ticks arrive on a stream, are scored, and go to a JSON table and to a topic payload folder.

    Per ticker: rows stored, rows sent, rows whose labels do not fit their cluster, and rows whose cluster is
    not that of the nearest centre of the tick's features.
    """
    features = ml_features(fx.bars(spark, sf))
    model = cluster.train_clusters(features)
    order = cluster.volatility_order(cluster.predict_into(features, model), 4)
    path, out, topic = (scratch_path(spark, f"score-{n}") for n in ("in", "out", "topic"))
    write_text(_payload(fx.tick_rows(spark, sf)), path)

    def send(rows):
        rows.write.mode("append").parquet(topic)

    started = tk.start_scoring(
        tk.accepted(_stream(spark, path)), model, out, scratch_path(spark, "score-ck"), order, send, ONCE
    )
    _drain(started)
    sent = spark.read.parquet(topic).groupBy(F.col("key").alias("ticker")).agg(F.count(F.lit(1)).alias("n_sent"))
    layout = "ticker string, open double, high double, low double, close double, volume long, cluster int"
    stored = spark.read.schema(f"{layout}, risk_level string, market_sentiment string").json(out)
    stored = tk.tick_features(stored)
    number = F.get(F.array(*map(F.lit, order)), cluster.nearest_centre(model))
    c = F.col("cluster")
    risk = F.when(c == 3, "high").when(c == 2, "medium").when(c.isin(0, 1), "low")
    fits = (F.col("risk_level") == risk) & ((F.col("market_sentiment") == "bullish") == (c <= 1))
    scored = stored.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(~F.coalesce(fits, F.lit(False))).alias("n_mislabeled"),
        F.count_if(~F.coalesce(c == number, F.lit(False))).alias("n_misplaced"),
    )
    return scored.join(sent, "ticker")
