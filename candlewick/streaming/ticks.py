"""Tick streams: parse, aggregate by event-time window, score, store."""

from __future__ import annotations

import datetime
import math
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.functions.scalar import bands, floor_clip, parse_timestamp
from candlewick.schemas import RISK_BANDS, RISK_BELOW, TICK
from candlewick.sources import folders
from candlewick.sources.sinks import to_kafka_value

TICK_PRICES = ("open", "high", "low", "close", "volume")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keeps window state on local disk with changelogs, for state larger than executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def read_ticks(
    spark: SparkSession, options: Mapping[str, str], schema: StructType = TICK, fmt: str = "kafka"
) -> DataFrame:
    """Stream of parsed ticks from a topic, or from any streaming source with a ``value`` column."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "latest")
    elif fmt == "text":
        reader = reader.schema("value string")
    return parse_ticks(reader.options(**options).load(), schema)


def parse_ticks(df: DataFrame, schema: StructType = TICK, value: str = "value") -> DataFrame:
    """JSON in ``value`` to typed columns plus ``event_time`` and ``reject``.

    ``reject`` is null for a good row, else 'malformed' or 'bad_time'. Nothing raises and nothing is
    lost: :func:`accepted` keeps the good rows, :func:`rejected` the others with their text.
    """
    text = F.col(value).cast("string")
    with_raw = StructType([*schema.fields, StructField("_raw", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
    rows = df.select(F.from_json(text, with_raw, options).alias("data"), text.alias("_text"))
    event_time = parse_timestamp(F.col("data.timestamp"))
    broken = F.col("data").isNull() | F.col("data._raw").isNotNull()
    reject = F.when(broken, "malformed").when(event_time.isNull(), "bad_time")
    return rows.select(
        *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields],
        event_time.alias("event_time"),
        reject.alias("reject"),
        "_text",
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).drop("reject", "_text")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNotNull()).select("reject", F.col("_text").alias("value"))


def tick_windows(
    ticks: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes"
) -> DataFrame:
    """Tumbling event-time windows per ticker. Works on a stream and, with equal results, on a table."""
    rows = ticks.withWatermark("event_time", watermark) if ticks.isStreaming else ticks
    out = rows.groupBy(F.window("event_time", window), "ticker").agg(
        F.avg("close").alias("avg_close"),
        F.max("close").alias("max_close"),
        F.min("close").alias("min_close"),
        F.avg("open").alias("avg_open"),
        F.sum("volume").alias("total_volume"),
    )
    return out.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in out.columns if c != "window"],
    )


def start_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time_column: str = "window_start",
    mode: str = "update",
    trigger: Mapping[str, object] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    writers: int | None = None,
    rows_per_file: int | None = None,
) -> StreamingQuery:
    """Stores every micro-batch below ``path/dt=.../batch_id=...``.

    A batch that is repeated after a failure overwrites exactly what it wrote before, so the table
    holds each batch once. ``dt`` comes from event time and prunes later reads. ``prepare`` may
    shape a batch before it is written; the batch is evaluated once. ``writers`` spreads the
    aggregated rows evenly over that many tasks, which bounds the files per day and batch;
    ``rows_per_file`` picks their number from the rows of each batch instead.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        rows = rows.withColumns({
            "dt": F.to_date(time_column), "batch_id": F.lit(batch_id).cast("long"),
        })
        tasks = writers
        if rows_per_file:
            rows = rows.persist()
            tasks = max(1, math.ceil(rows.count() / rows_per_file))
        try:
            (
                (rows.repartition(tasks) if tasks else rows)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("dt", "batch_id")
                .parquet(path)
            )
        finally:
            if rows_per_file:
                rows.unpersist()

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).foreachBatch(write).start()


WINDOW_KEYS = ("window_start", "window_end", "ticker")


def upsert_latest(
    stored: DataFrame,
    keys: Sequence[str] = WINDOW_KEYS,
    version: str = "batch_id",
    since: datetime.date | None = None,
    until: datetime.date | None = None,
) -> DataFrame:
    """The final row per window and ticker of an update-mode sink: the one of its newest batch.

    ``since`` and ``until`` (both included) leave all other day folders unread: a window's ``dt``
    follows from its start, so all versions of it lie in one folder.
    """
    if since is not None:
        stored = stored.filter(F.col("dt") >= F.lit(since))
    if until is not None:
        stored = stored.filter(F.col("dt") <= F.lit(until))
    rest = [c for c in stored.columns if c not in (*keys, version, "dt")]
    # A batch holds each key once, so all columns come from the same row; nulls count as values.
    return (
        stored.groupBy(*keys)
        .agg(*[F.max_by(c, version).alias(c) for c in rest])
    )


def closed_days(
    spark: SparkSession, path: str, window: str = "5 minutes", watermark: str = "10 minutes",
    time_column: str = "window_end",
) -> list[datetime.date]:
    """Days of the sink that no batch can write to any more.

    The newest stored window ends at most one window after the newest tick. A day is closed when it
    ended more than window and watermark before that. Only day names and one time reach the driver.
    """
    days = sorted(folders.values_of(spark, path, "dt"))
    if not days:
        return []
    newest = spark.read.parquet(path).filter(F.col("dt") == F.lit(days[-1])).agg(F.max(time_column).alias("newest"))
    limit = F.col("newest") - F.expr(f"INTERVAL {window}") - F.expr(f"INTERVAL {watermark}")
    last = newest.select(F.date_sub(F.to_date(limit), 1)).first()[0]
    return [] if last is None else [d for d in map(datetime.date.fromisoformat, days) if d <= last]


def compact_days(
    spark: SparkSession,
    path: str,
    closed: str,
    days: Sequence[datetime.date],
    keys: Sequence[str] = WINDOW_KEYS,
    file_bytes: int = 128 << 20,
) -> list[datetime.date]:
    """Moves closed days from the sink at ``path`` to ``closed``: one row per key, few files, no versions.

    A day is written aside and becomes visible by one rename of its folder; then its updates are
    deleted. Whatever is interrupted is done again by the next call, and :func:`read_windows` gives
    the same rows at every moment. The number of files follows from the bytes of the day's updates.
    """
    done = []
    for day in days:
        source, target = f"{path}/dt={day}", f"{closed}/dt={day}"
        if not folders.exists(spark, target):
            aside = f"{closed}/_aside-{uuid.uuid4().hex}/dt={day}"
            files = max(1, math.ceil(folders.size(spark, source) / file_bytes))
            rows = upsert_latest(spark.read.option("basePath", path).parquet(source), keys)
            rows.repartition(files, *keys).write.parquet(aside)
            folders.rename(spark, aside, target)
            folders.delete(spark, aside.rsplit("/", 1)[0])
            done.append(day)
        folders.delete(spark, source)
    return done


def read_windows(
    spark: SparkSession,
    path: str,
    closed: str,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
    keys: Sequence[str] = WINDOW_KEYS,
) -> DataFrame:
    """The final rows of a sink: closed days as they are, the updates of open days regrouped.

    Only folders of the asked days are listed and read. A day whose updates were not deleted yet
    counts as closed.
    """
    def asked(folder: str) -> list[str]:
        days = folders.values_of(spark, folder, "dt")
        low, high = str(since or datetime.date.min), str(until or datetime.date.max)
        return sorted(d for d in days if low <= d <= high)

    final = asked(closed)
    open_days = [d for d in asked(path) if d not in set(final)]
    parts = []
    if open_days:
        updates = spark.read.option("basePath", path).parquet(*[f"{path}/dt={d}" for d in open_days])
        parts.append(upsert_latest(updates, keys))
    if final:
        parts.append(spark.read.option("basePath", closed).parquet(*[f"{closed}/dt={d}" for d in final]).drop("dt"))
    if not parts:
        raise FileNotFoundError(f"no day of {path} or {closed} is asked for")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


LATE = "batch_id long, n_ticks long, n_late long, newest_us long, watermark_us long"


def start_late_audit(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "5 minutes",
    watermark: str = "10 minutes",
    trigger: Mapping[str, object] | None = None,
    keep: str | None = None,
) -> StreamingQuery:
    """Counts the late ticks of every micro-batch, before anything is aggregated.

    A tick is late if its window had ended by the watermark: the newest event time of all earlier
    batches, less the delay. (Spark itself may still take a tick whose window ended with the batch
    right before.) Each batch stores one row below ``path/batch_id=...``; the row carries the newest
    time so far, so a batch reads the row of the batch before it and nothing else, and a batch that is
    repeated overwrites its own. Times are microseconds. With ``keep``, late ticks are stored there by
    batch instead of being lost.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, None
        if batch_id:
            before = spark.read.schema(LATE).parquet(f"{path}/batch_id={batch_id - 1}").first()["newest_us"]
        known = F.lit(before).cast("long")
        limit = F.unix_micros(F.timestamp_micros(known) - F.expr(f"INTERVAL {watermark}"))
        ends = F.unix_micros(F.window("event_time", window)["end"])
        marked = batch.withColumn("_late", F.coalesce(ends <= limit, F.lit(False)))
        if keep:
            marked = marked.persist()
        try:
            marked.agg(
                F.count(F.lit(1)).alias("n_ticks"),
                F.count_if("_late").alias("n_late"),
                F.greatest(F.max(F.unix_micros("event_time")), known).alias("newest_us"),
                F.max(limit).alias("watermark_us"),
            ).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            if keep:
                marked.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{keep}/batch_id={batch_id}")
        finally:
            if keep:
                marked.unpersist()

    writer = ticks.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).foreachBatch(write).start()


def late_batches(spark: SparkSession, path: str) -> DataFrame:
    """The audit's rows: one per micro-batch."""
    return spark.read.schema(LATE).parquet(path)


def late_ticks(audited: DataFrame) -> DataFrame:
    """All ticks and all late ones, over any number of batches."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return audited.agg(total("n_ticks"), total("n_late"), F.count(F.lit(1)).alias("n_batches"))


def tick_features(ticks: DataFrame) -> DataFrame:
    """Model inputs of a single tick; what needs history has a neutral constant."""
    opened = floor_clip("open", 1.0, 0.01)
    high, low, close = (F.coalesce(c, F.lit(0.0)) for c in ("high", "low", "close"))
    zero = F.lit(0.0)
    return ticks.withColumns({
        "Returns_1d": zero,
        "Returns_5d": zero,
        "Volatility_5d": zero,
        "Volume_Change": zero,
        "Price_Range_Pct": (high - low) / opened,
        "Close_Open_Ratio": close / opened,
        "SMA_Cross": zero,
        "RSI": F.lit(50.0),
        "Volume": F.coalesce("volume", F.lit(0)).cast("double"),
    })


def with_risk_labels(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Risk level and market sentiment of a cluster number."""
    return df.withColumns({
        "risk_level": bands(cluster, RISK_BANDS, RISK_BELOW),
        "market_sentiment": F.when(F.col(cluster) <= 1, "bullish").when(F.col(cluster) > 1, "bearish"),
    })


def score_ticks(
    ticks: DataFrame, model: PipelineModel, order: Sequence[int] | None = None
) -> DataFrame:
    """Cluster, risk level and sentiment per tick. ``order`` renumbers the raw clusters by risk."""
    # The tick travels as one struct, because the model input Volume would replace its volume.
    features = tick_features(ticks.select(F.struct("*").alias("tick"), *TICK_PRICES))
    cluster = F.col("prediction") if order is None else F.get(
        F.array(*[F.lit(i) for i in order]), F.col("prediction")
    )
    scored = model.transform(features).select("tick.*", cluster.alias("cluster"))
    return with_risk_labels(scored).withColumn("prediction_time", F.current_timestamp())


def start_scoring(
    ticks: DataFrame,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    order: Sequence[int] | None = None,
    send: Callable[[DataFrame], None] | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Scores a tick stream into a JSON table and, with ``send``, a topic.

    ``send`` receives (key, value) rows with a ``type`` field; the batch is kept only when it is used
    twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("dt", F.to_date("event_time"))
        if send is not None:
            rows = rows.persist()
        try:
            stored = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
            (
                stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("dt", "batch_id").json(path)
            )
            if send is not None:
                send(to_kafka_value(rows.drop("dt").withColumn("type", F.lit("prediction")), "ticker"))
        finally:
            if send is not None:
                rows.unpersist()

    scored = score_ticks(ticks, model, order)
    writer = scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).foreachBatch(write).start()
