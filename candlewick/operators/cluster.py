"""Clustering of feature rows with Spark ML."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.dedup import dedup_newest
from candlewick.operators.filters import drop_incomplete
from candlewick.operators.joins import enrich_with_cluster_means
from candlewick.operators.summary import value_counts
from candlewick.operators.series import Series, newest_rows
from candlewick.schemas import CLUSTER_FEATURES
from candlewick.session import cut_lineage


#: Restarts of a training that run at the same time.
AT_ONCE = 5

#: How far a trained centre may lie from the mean of its rows, in standard deviations: training stops
#: when no centre moves by more than a hundredth.
SETTLED = 0.02


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return drop_incomplete(doubles, columns)


def _scaled(df: DataFrame, columns: Sequence[str]):
    """Fitted assembler and scaler, and the scaled vectors of the complete rows.

    The rows are read many times, so their lineage (file scans, windows) is cut first: a lost
    executor costs a read of the checkpoint, not a rerun of the feature job.
    """
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features_raw")
    raw = cut_lineage(assembler.transform(_complete(df, columns)).select("features_raw"))
    if raw.isEmpty():
        raise ValueError("no row has all model inputs: " + ", ".join(columns))
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    fitted = scaler.fit(raw)
    vectors = fitted.transform(raw).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    return assembler, fitted, vectors


def _best_fit(vectors: DataFrame, k: int, restarts: int, seed: int):
    """The restarts run a few at a time: each is a chain of small jobs that leaves most tasks idle."""

    def fit(i: int):
        return KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="prediction").fit(vectors)

    vectors.count()  # fills the cache once, not in every restart
    with ThreadPool(min(restarts, AT_ONCE)) as pool:
        fits = pool.map(fit, range(restarts))
    best = None
    for fit in fits:
        # Costs of equal solutions differ in the last bits from run to run; the first one is kept.
        if best is None or fit.summary.trainingCost < best.summary.trainingCost * (1 - 1e-9):
            best = fit
    return best


def train_clusters(
    df: DataFrame,
    columns: Sequence[str] = CLUSTER_FEATURES,
    k: int = 4,
    restarts: int = 10,
    seed: int = 42,
) -> PipelineModel:
    """Standardise, then k-means; the restart with the lowest cost wins."""
    assembler, scaler, vectors = _scaled(df, columns)
    try:
        return PipelineModel([assembler, scaler, _best_fit(vectors, k, restarts, seed)])
    finally:
        vectors.unpersist()


def cluster_metrics(model: PipelineModel, df: DataFrame) -> dict:
    """Samples, inertia, silhouette (squared Euclidean, scaled vectors) and cluster sizes.

    Scaling here divides by the sample deviation; inertia is given for population scaling.
    """
    columns = model.stages[0].getInputCols()
    scored = model.transform(_complete(df, columns)).select("features", "prediction")
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["prediction"]: r["n"] for r in value_counts(scored, "prediction").collect()}
        n = sum(sizes.values())
        cost = model.stages[2].summary.trainingCost if model.stages[2].hasSummary else None
        silhouette = ClusteringEvaluator().evaluate(scored) if len(sizes) > 1 else None
    finally:
        scored.unpersist()
    return {
        "k": model.stages[2].getK(),
        "n_samples": n,
        "feature_names": list(columns),
        "inertia": None if cost is None else cost * n / max(n - 1, 1),
        "silhouette": silhouette,
        "sizes": sizes,
    }


def sweep(
    df: DataFrame,
    ks: Sequence[int] = (3, 4, 5),
    columns: Sequence[str] = CLUSTER_FEATURES,
    restarts: int = 10,
    seed: int = 42,
) -> DataFrame:
    """One row per k: samples, cost and silhouette, from one set of scaled vectors."""
    _, _, vectors = _scaled(df, columns)
    rows = []
    try:
        for k in ks:
            best = _best_fit(vectors, k, restarts, seed)
            n = sum(best.summary.clusterSizes)
            silhouette = ClusteringEvaluator().evaluate(best.transform(vectors))
            rows.append((k, n, best.summary.trainingCost * n / max(n - 1, 1), silhouette))
    finally:
        vectors.unpersist()
    layout = "k int, n_samples long, inertia double, silhouette double"
    return df.sparkSession.createDataFrame(rows, layout)


def audit_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """What must hold for any trained model, one row per cluster that has rows.

    ``n`` rows, ``n_misplaced`` of them nearer to another centre, ``off_mean`` the largest distance on
    one axis between the centre and the mean of its rows, ``cost`` the summed squared distances.
    """
    columns = list(model.stages[0].getInputCols())
    centers = [[float(x) for x in c] for c in model.stages[2].clusterCenters()]
    scored = model.transform(_complete(df, columns)).select(
        F.col("prediction").alias("cluster"), vector_to_array("features").alias("x")
    )

    def distance(center: list[float]):
        squares = [(F.col("x")[i] - F.lit(value)) * (F.col("x")[i] - F.lit(value)) for i, value in enumerate(center)]
        return reduce(operator.add, squares)

    measured = scored.withColumn("d", F.array(*[distance(c) for c in centers]))
    mine = F.get("d", F.col("cluster"))
    per_axis = [F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(columns))]
    rows = measured.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(mine > F.array_min("d") + 1e-9).alias("n_misplaced"),
        F.sum(mine).alias("cost"), *per_axis,
    )
    of = F.get(F.array(*[F.array(*map(F.lit, c)) for c in centers]), F.col("cluster"))
    off = F.greatest(*[F.abs(F.col(f"m{i}") - of[i]) for i in range(len(columns))], F.lit(0.0))
    return rows.select("cluster", "n", "n_misplaced", off.alias("off_mean"), "cost")


def nearest_centre(model: PipelineModel) -> Column:
    """The number of the centre nearest to a row, from the model's numbers alone: what its prediction must be.

    Null where an input is missing."""
    scaler, centers = model.stages[1], model.stages[2].clusterCenters()
    axes = []
    for i, c in enumerate(model.stages[0].getInputCols()):
        value = F.col(c).cast("double")
        value = value - F.lit(float(scaler.mean[i])) if scaler.getWithMean() else value
        spread = float(scaler.std[i])
        axes.append(value * F.lit(1 / spread if spread else 0.0) if scaler.getWithStd() else value)

    def distance(center: Sequence[float]) -> Column:
        return reduce(operator.add, [(x - F.lit(float(at))) * (x - F.lit(float(at))) for x, at in zip(axes, center, strict=True)])

    distances = F.array(*[distance(c) for c in centers])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def predict_into(df: DataFrame, model: PipelineModel, target: str = "Cluster") -> DataFrame:
    """Adds the cluster of every complete row; rows with a missing feature stay, with null.

    One pass: incomplete rows are scored on stand-in values and the result is discarded.
    """
    columns = list(model.stages[0].getInputCols())
    whole = F.lit(True)
    for c in columns:
        d = F.col(c).cast("double")
        whole = whole & d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))
    kept = df.select(F.struct(*df.columns).alias("_row"), whole.alias("_whole"))
    inputs = kept.withColumns({
        c: F.when(F.col("_whole"), F.col(f"_row.{c}").cast("double")).otherwise(F.lit(0.0))
        for c in columns
    })
    scored = model.transform(inputs)
    return scored.select(
        "_row.*", F.when(F.col("_whole"), F.col("prediction")).alias(target)
    )


def volatility_order(df: DataFrame, k: int, key: str = "Cluster", by: str = "Volatility_5d") -> list[int]:
    """New number of each raw cluster, so that 0 is the calmest. Collects at most k rows."""
    means = (
        df.filter(F.col(key).between(0, k - 1)).groupBy(key).agg(F.avg(by).alias("m"))
        .orderBy(F.col("m").asc_nulls_last(), key)
    )
    ranked = [r[key] for r in means.collect()]
    ranked += [c for c in range(k) if c not in ranked]
    return [ranked.index(c) for c in range(k)]


def relabel(df: DataFrame, order: Sequence[int], key: str = "Cluster") -> DataFrame:
    """Replaces each cluster number by its rank; the cluster number then tells the risk."""
    table = F.array(*[F.lit(i) for i in order])
    return df.withColumn(key, F.get(table, F.col(key)))


def score_batch(
    features: DataFrame,
    model: PipelineModel,
    keys: Sequence[str] = ("Ticker", "Date"),
    recency: str | None = None,
    order: Sequence[int] | None = None,
) -> DataFrame:
    """Deduplicate (newest file wins, when ``recency`` names its column), score, enrich.

    ``order`` renumbers the clusters, see :func:`volatility_order`; compute it once, at training. The
    scored rows feed both the cluster means and the result, so they are checkpointed in between.
    """
    rows = dedup_newest(features, keys, recency) if recency else features
    scored = predict_into(rows, model)
    if order is not None:
        scored = relabel(scored, order)
    return enrich_with_cluster_means(cut_lineage(scored))


def series_analysis(df: DataFrame, key: str = "Ticker", ts: str = "Date", last: int = 5) -> DataFrame:
    """Per entity: newest close and cluster, rows per cluster, last closes in time order."""
    newest_facts = df.groupBy(key).agg(
        F.max_by("Close", ts).alias("latest_close"), F.max_by("Cluster", ts).alias("latest_cluster")
    )
    counts = df.filter(F.col("Cluster").isNotNull()).groupBy(key, "Cluster").agg(
        F.count(F.lit(1)).alias("n")
    )
    # One entry per cluster, and ``last`` entries: both lists are short by construction.
    spread = counts.groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("Cluster", "n")))).alias("distribution")
    )
    recent = newest_rows(df.select(key, ts, "Close"), last, Series((key,), ts)).groupBy(key).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), F.col("Close").alias("c")))),
            lambda s: s["c"],
        ).alias("recent_closes")
    )
    return newest_facts.join(spread, key, "left").join(recent, key, "left")
