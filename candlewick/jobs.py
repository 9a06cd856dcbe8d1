"""The daily jobs, put together from the operators.

Each job reads and writes folders that all executors can reach:

    python -m candlewick.jobs etl --raw s3a://lake/raw --out s3a://lake/etl

A job is lazy up to its sinks and brings nothing larger than a model card to the driver.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.scalar import normalize_symbol, predictions_map
from candlewick.operators import cluster, features, forecast as fc, monitor, privacy, quality, runs
from candlewick.operators.bars import with_daily_change
from candlewick.operators.dedup import dedup_newest
from candlewick.operators.filters import filter_symbol
from candlewick.operators.joins import with_symbol_name
from candlewick.operators.series import longest_streak, min_rows, trailing_streak
from candlewick.schemas import BAR, RAW_BAR, SYMBOL_NAMES, TRADER
from candlewick.session import build_session
from candlewick.sources import files, sinks
from candlewick.streaming import ticks as tk

MIN_TRAIN_ROWS = 120


def load_bars(spark: SparkSession, raw: str) -> DataFrame:
    """All bar files below ``raw``: canonical symbols, one row per symbol and day, newest file first."""
    rows = files.read_prefix(spark, raw, BAR).withColumn("Ticker", normalize_symbol("Ticker"))
    ties = ("_source_file", "Close", "Open", "High", "Low", "Volume")
    rows = dedup_newest(rows, ("Ticker", "Date"), "_source_modified", ties)
    return rows.drop("_source_file", "_source_modified")


def etl(spark: SparkSession, raw: str, out: str, stamp: str | None = None, codec: str | None = None) -> str:
    """Moving averages, volatility and range of all bars."""
    return sinks.write_features(features.etl_features(load_bars(spark, raw)), out, codec=codec, stamp=stamp)


def publish_bars(spark: SparkSession, raw: str, out: str) -> None:
    """Named bars with their daily change, one CSV folder per symbol."""
    bars = with_daily_change(with_symbol_name(load_bars(spark, raw), SYMBOL_NAMES), round_to=2)
    sinks.write_per_entity(bars.select(*BAR.fieldNames()), out)


def engineer(spark: SparkSession, raw: str, out: str, stamp: str | None = None) -> str:
    """The full feature set of all bars."""
    return sinks.write_features(features.ml_features(load_bars(spark, raw)), out, stamp=stamp)


def train(spark: SparkSession, features_dir: str, store: str, k: int = 4, restarts: int = 10) -> str:
    """Clusters of the newest feature run, numbered from calm to volatile; returns the run id."""
    rows = files.latest_files(spark, features_dir, 1, by="run")
    model = cluster.train_clusters(rows, k=k, restarts=restarts)
    order = cluster.volatility_order(cluster.predict_into(rows, model), k)
    found = cluster.cluster_metrics(model, rows)
    metrics = {"n_samples": found["n_samples"], **{f"size_{c}": n for c, n in found["sizes"].items()}}
    metrics |= {m: found[m] for m in ("inertia", "silhouette") if found[m] is not None}
    params = {"k": k, "features": ",".join(found["feature_names"]), "order": ",".join(map(str, order))}
    return runs.save_model(model, store, "clusters", params, metrics)


def _newest_model(spark: SparkSession, store: str):
    model, card = runs.load_latest(spark, store, "clusters")
    return model, [int(c) for c in card["params"]["order"].split(",")]


def score(spark: SparkSession, features_dir: str, store: str, out: str, n: int = 5) -> DataFrame:
    """Scores the newest ``n`` feature runs with the newest model; returns the analysis per symbol."""
    model, order = _newest_model(spark, store)
    rows = files.latest_files(spark, features_dir, n, by="run")
    scored = cluster.score_batch(rows, model, recency="_source_modified", order=order)
    sinks.write_features(scored.drop("_source_file", "_source_modified"), out)
    return cluster.series_analysis(spark.read.parquet(out))


def estimate(spark: SparkSession, raw: str, symbol: str = "JKSE", target: float = 6000.0) -> DataFrame:
    """Days to the target at the mean return, with the longest and the current run at or above it."""
    bars = filter_symbol(load_bars(spark, raw), symbol)
    returns = features.pct_change(bars, "Close", 1, name="Returns_1d")
    hit = F.col("Close") >= target
    estimated = fc.days_to_target(returns, target)
    return estimated.join(longest_streak(bars, hit), "Ticker").join(trailing_streak(bars, hit), "Ticker")


def predict(
    spark: SparkSession,
    raw: str,
    store: str,
    out: str,
    symbol: str = "JKSE",
    target: float = 6000.0,
    seq_len: int = 60,
    steps: int = 7,
) -> DataFrame:
    """Trains the lag model of a symbol, stores its forecast as a document, returns the first hit."""
    bars = min_rows(filter_symbol(load_bars(spark, raw), symbol), max(MIN_TRAIN_ROWS, 2 * seq_len))
    model = fc.train_forecaster(bars, n=seq_len)
    runs.log_run(spark, f"{store}/runs", "lag_forecast", {"seq_len": seq_len}, model.metrics)
    steps_ahead = fc.forecast(bars, model.coefficients, model.intercept, steps)
    hits = fc.first_hit(steps_ahead, target)
    # ``steps`` entries per symbol.
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("step", "predicted"))), lambda s: s["predicted"]
    )
    docs = steps_ahead.groupBy("Ticker").agg(
        F.date_sub(F.min("day"), 1).alias("_last"), F.max("latest_close").alias("latest_close"),
        ordered.alias("_values"),
    ).join(hits, "Ticker").select(
        F.current_timestamp().alias("prediction_date"), "Ticker", "latest_close",
        predictions_map("_last", "_values").alias("predictions"),
        F.col("first_step").alias("days_to_target"), "status",
        F.lit("lag_regression").alias("model"), F.lit(seq_len).alias("seq_len"),
    )
    sinks.append_docs(docs, out)
    return hits


def check(spark: SparkSession, raw: str, out: str, audit: str, exact: bool = True) -> DataFrame:
    """Profiles the raw files as text, stores the report and an audit entry; returns the score."""
    rows = files.read_prefix(spark, raw, RAW_BAR).drop("_source_modified")
    totals = quality.quality_score(quality.overall(rows))
    columns = quality.profile(rows.drop("_source_file"), exact=exact)
    report = quality.nested_report(columns, totals, raw).withColumn("timestamp", F.current_timestamp())
    sinks.append_docs(report, out)
    quality.audit(spark, audit, "data_quality_check", "completed", "candlewick", {"dataset": raw})
    return totals


def mask(spark: SparkSession, people: str, out: str, record: str | None = None) -> None:
    """Masks a table of people, stores it as CSV, and appends what was done to the documents in ``record``."""
    rows = spark.read.schema(TRADER).option("header", True).csv(people)
    privacy.mask_table(rows).write.mode("overwrite").option("header", True).csv(out)
    if record:
        done = privacy.masking_record(rows, original_file=people, masked_file=out)
        sinks.append_docs(done.withColumn("timestamp", F.current_timestamp()), record)


def export_logs(spark: SparkSession, documents: str, text_logs: str, out: str, index: str = "pipeline-logs") -> None:
    """Log documents with all their fields, and plain log files, as search-bulk text."""
    docs = monitor.normalize_docs(files.read_text_docs(spark, documents))
    texts = monitor.normalize_text_logs(
        files.read_text_heads(spark, text_logs, monitor.MESSAGE_LENGTH, "*.log")
    )
    logs = docs.unionByName(texts, allowMissingColumns=True)
    sinks.write_text(sinks.to_bulk_documents(logs, index, F.sha2("source_file", 256), monitor.COMMON), out)


def stream(spark: SparkSession, servers: str, topic: str, out: str, checkpoint: str) -> None:
    """Five-minute windows of a tick topic and an audit of its late ticks, until stopped.

    Windows go to ``out/updates``, the audit to ``out/late``, late ticks to ``out/late_ticks``; run
    ``compact`` every day. Needs the Kafka connector.
    """
    tk.use_rocksdb_state(spark)
    ticks = tk.accepted(tk.read_ticks(spark, {"kafka.bootstrap.servers": servers, "subscribe": topic}))
    tk.start_late_audit(ticks, f"{out}/late", f"{checkpoint}/late", keep=f"{out}/late_ticks")
    tk.start_sink(tk.tick_windows(ticks), f"{out}/updates", f"{checkpoint}/windows", rows_per_file=1_000_000)
    spark.streams.awaitAnyTermination()


def compact(spark: SparkSession, out: str, mb_per_file: int = 128) -> int:
    """Moves the closed days of ``stream`` to ``out/closed``, one row per window; returns their number."""
    updates = f"{out}/updates"
    days = tk.closed_days(spark, updates)
    return len(tk.compact_days(spark, updates, f"{out}/closed", days, file_bytes=mb_per_file << 20))


def score_stream(
    spark: SparkSession, servers: str, topic: str, store: str, out: str, checkpoint: str, reply: str
) -> None:
    """Scores a tick topic into a JSON table and a reply topic, until stopped."""
    model, order = _newest_model(spark, store)
    ticks = tk.read_ticks(spark, {"kafka.bootstrap.servers": servers, "subscribe": topic})

    def send(rows: DataFrame) -> None:
        sinks.write_to_topic(rows, {"kafka.bootstrap.servers": servers, "topic": reply})

    tk.start_scoring(tk.accepted(ticks), model, out, checkpoint, order, send).awaitTermination()


JOBS = (
    etl, publish_bars, engineer, train, score, estimate, predict, check, mask, export_logs, stream, compact, score_stream,
)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="candlewick.jobs", description=__doc__.split("\n", 1)[0])
    commands = parser.add_subparsers(dest="job", required=True)
    for job in JOBS:
        command = commands.add_parser(job.__name__, help=(job.__doc__ or "").split("\n", 1)[0])
        for name, p in list(inspect.signature(job).parameters.items())[1:]:
            required = p.default is inspect.Parameter.empty
            kind = str if required or p.default is None else type(p.default)
            if kind is bool:
                command.add_argument(f"--{name}", action=argparse.BooleanOptionalAction, default=p.default)
            else:
                command.add_argument(f"--{name}", type=kind, required=required, default=None if required else p.default)
    options = vars(parser.parse_args(argv))
    job = {j.__name__: j for j in JOBS}[options.pop("job")]
    result = job(build_session(), **options)
    if isinstance(result, DataFrame):
        result.show(truncate=False)
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main()
