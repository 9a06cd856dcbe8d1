"""Run table (parameters, metrics, artifact per run) and the model store built on it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.schemas import RUN


def log_run(
    spark: SparkSession,
    path: str,
    pipeline: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    artifact: str | None = None,
    status: str = "completed",
    run_id: str | None = None,
) -> str:
    """Appends one run and returns its id."""
    run_id = run_id or uuid.uuid4().hex
    row = {
        "run_id": run_id,
        "timestamp": datetime.now(timezone.utc),
        "pipeline": pipeline,
        "status": status,
        "params": {k: str(v) for k, v in (params or {}).items()},
        "metrics": {k: float(v) for k, v in (metrics or {}).items()},
        "artifact": artifact,
    }
    append_runs(spark.createDataFrame([row], RUN), path)
    return run_id


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN).parquet(path)


def search_runs(runs: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    """Runs ordered by a metric; runs without it come last."""
    value = F.try_element_at(F.col("metrics"), F.lit(metric))
    key = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return runs.orderBy(key, "run_id")


def save_model(
    model: PipelineModel,
    store: str,
    pipeline: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
) -> str:
    """Saves the fitted stages and registers them as a run; returns the run id."""
    spark = SparkSession.active()
    run_id = uuid.uuid4().hex
    artifact = f"{store}/models/{pipeline}-{run_id}"
    model.write().overwrite().save(artifact)
    return log_run(spark, f"{store}/runs", pipeline, params, metrics, artifact, run_id=run_id)


def load_latest(spark: SparkSession, store: str, pipeline: str) -> tuple[PipelineModel, dict]:
    """Newest saved model of a pipeline, with its run."""
    runs = read_runs(spark, f"{store}/runs").filter(
        (F.col("pipeline") == pipeline) & F.col("artifact").isNotNull()
    )
    row = runs.orderBy(F.col("timestamp").desc(), F.col("run_id").desc()).first()
    if row is None:
        raise FileNotFoundError(f"no saved model of {pipeline}")
    return PipelineModel.load(row["artifact"]), row.asDict()
