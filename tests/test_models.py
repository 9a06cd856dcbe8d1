"""Clustering and forecasting."""

import datetime
import functools
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators import cluster, forecast, runs
from candlewick.operators.series import BARS, Series, Split, chrono_split, sequences

START = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(5)
    rows = [
        (f"T{i % 3}", START + datetime.timedelta(days=i), c * 10 + rng.random(), c * 5 + rng.random(),
         float(c), 0.1 * c, 0.01)
        for i in range(300) for c in [i % 3]
    ]
    rows.append(("T9", START, None, 1.0, 1.0, 0.1, 0.0))
    layout = "Ticker string, Date date, x double, y double, Close double, Volatility_5d double, Returns_1d double"
    return spark.createDataFrame(rows, layout).cache()


def test_clusters_are_found_and_stable(blobs):
    a = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=3)
    b = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=3)
    for left, right in zip(a.stages[2].clusterCenters(), b.stages[2].clusterCenters()):
        assert list(left) == pytest.approx(list(right), abs=1e-9)
    found = cluster.cluster_metrics(a, blobs)
    assert sorted(found["sizes"].values()) == [100, 100, 100] and found["n_samples"] == 300
    assert found["silhouette"] > 0.9


def test_best_restart_wins(blobs):
    one = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=1)
    many = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=4)
    assert many.stages[2].summary.trainingCost <= one.stages[2].summary.trainingCost + 1e-9


def test_incomplete_rows_keep_a_null_cluster(blobs):
    model = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=1)
    scored = cluster.predict_into(blobs, model)
    assert scored.count() == 301 and scored.columns == [*blobs.columns, "Cluster"]
    assert [r["Ticker"] for r in scored.filter("Cluster IS NULL").collect()] == ["T9"]


def test_training_needs_a_complete_row(blobs):
    with pytest.raises(ValueError, match="x, y"):
        cluster.train_clusters(blobs.filter("x IS NULL"), ["x", "y"], k=3, restarts=1)


def test_labels_follow_volatility(blobs):
    model = cluster.train_clusters(blobs, ["x", "y"], k=3, restarts=1)
    scored = cluster.predict_into(blobs, model)
    calm_first = cluster.relabel(scored, cluster.volatility_order(scored, 3))
    means = [r["m"] for r in calm_first.filter("Cluster IS NOT NULL").groupBy("Cluster")
             .agg(F.avg("Volatility_5d").alias("m")).orderBy("Cluster").collect()]
    assert means == sorted(means)
    enriched = cluster.score_batch(blobs, model)
    assert enriched.filter("Cluster IS NULL AND Cluster_Avg_Close IS NOT NULL").count() == 0
    assert enriched.filter("Cluster IS NOT NULL AND abs(Price_vs_Cluster) > 1e-9").count() == 0


def test_model_store_returns_the_newest(spark, blobs, tmp_path):
    store = str(tmp_path)
    for k in (2, 3):
        model = cluster.train_clusters(blobs, ["x", "y"], k=k, restarts=1)
        runs.save_model(model, store, "clusters", {"k": k}, {"cost": model.stages[2].summary.trainingCost})
    loaded, card = runs.load_latest(spark, store, "clusters")
    assert card["params"]["k"] == "3" and loaded.stages[2].getK() == 3
    by_cost = runs.search_runs(runs.read_runs(spark, f"{store}/runs"), "cost").collect()
    assert [r["params"]["k"] for r in by_cost] == ["3", "2"]
    with pytest.raises(FileNotFoundError):
        runs.load_latest(spark, store, "other")


def walk(spark, n, ticker="A"):
    rng = random.Random(n)
    price, rows = 100.0, []
    for i in range(n):
        price += rng.uniform(-1, 1.2)
        rows.append((ticker, START + datetime.timedelta(days=i), price))
    return rows, spark.createDataFrame(rows, "Ticker string, Date date, Close double")


def test_forecaster(spark):
    _, df = walk(spark, 200)
    model = forecast.train_forecaster(df, n=10)
    assert model.n == 10 and 0 <= model.metrics["val_mae"] < 50 and model.metrics["val_loss"] >= 0
    out = forecast.forecast(df, model.coefficients, model.intercept).orderBy("step").collect()
    last = START + datetime.timedelta(days=199)
    assert [r["step"] for r in out] == list(range(1, 8))
    assert [r["day"] for r in out] == [last + datetime.timedelta(days=i) for i in range(1, 8)]
    assert all(abs(r["predicted"]) < 1e6 for r in out)


def by_widened_rows(df, n, ridge, series=BARS):
    """The same model from rows that hold all their lags, by Spark ML's solver; with both errors."""
    rows = chrono_split(sequences(df, "Close", n, series), 0.8, series)
    rows = rows.select(array_to_vector("lags").alias("features"), F.col("label").cast("double"), "part")
    fit = LinearRegression(regParam=ridge, elasticNetParam=0.0, solver="normal").fit(rows.filter("part = 'train'"))
    error = F.col("prediction") - F.col("label")
    test = fit.transform(rows.filter("part = 'test'")).agg(F.avg(error * error), F.avg(F.abs(error))).first()
    return [*fit.coefficients, fit.intercept, *test]


@pytest.mark.parametrize(("n", "ridge", "block_rows"), [(1, 0.0, 2), (5, 0.1, 1), (5, 0.1, 16), (20, 3.0, 50)])
def test_forecaster_by_products_of_lags(spark, n, ridge, block_rows):
    """Series of many lengths, around those where a block or the training part ends."""
    frames = [walk(spark, k, f"t{k}")[1] for k in (1, 5, 6, 7, 16, 21, 22, 23, 48, 50, 51, 120)]
    df = functools.reduce(DataFrame.unionByName, frames)
    want = by_widened_rows(df, n, ridge)
    for series in (BARS, Series(split=Split("week"))):
        model = forecast.train_forecaster(df, n=n, ridge=ridge, block_rows=block_rows, series=series)
        got = [*model.coefficients, model.intercept, model.metrics["val_loss"], model.metrics["val_mae"]]
        assert got == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_forecaster_edges(spark):
    _, df = walk(spark, 60)
    layout = "Ticker string, Date date, Close double"
    odd = [(None, START, 1.0), ("A", START - datetime.timedelta(days=1), None), ("A", START + datetime.timedelta(days=90), float("nan")),
           ("B", START, float("inf"))]
    plain = forecast.train_forecaster(df, n=4)
    mixed = forecast.train_forecaster(df.unionByName(spark.createDataFrame(odd, layout)), n=4)
    assert [*mixed.coefficients, mixed.intercept] == pytest.approx([*plain.coefficients, plain.intercept], rel=1e-9)
    flat = spark.createDataFrame([("A", START + datetime.timedelta(days=i), 7.5) for i in range(30)], layout)
    model = forecast.train_forecaster(flat, n=3)
    assert model.coefficients == (0.0, 0.0, 0.0) and model.intercept == pytest.approx(7.5)
    assert model.metrics == pytest.approx({"val_loss": 0.0, "val_mae": 0.0})
    unlabelled = forecast.train_forecaster(df, n=4, fraction=1.0)
    assert unlabelled.metrics == {"val_loss": None, "val_mae": None}
    with pytest.raises(ValueError, match="no series"):
        forecast.train_forecaster(df, n=60)
    with pytest.raises(ValueError, match="no series"):
        forecast.train_forecaster(df.limit(0), n=2)


def test_forecaster_moves_single_values(spark):
    """Stretches are stored after one exchange, and no row holds its lags."""
    pieces = forecast._pieces(walk(spark, 100)[1], "Close", 60, 0.8, BARS, 128)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sum(len(r["v"]) for r in pieces.collect()) <= 100 + 60


def test_recursion_matches_a_plain_loop(spark):
    rows, df = walk(spark, 61)
    weights, intercept = [0.25, 0.0, 0.25, 0.5], 3.0
    history = [r[2] for r in rows]
    for _ in range(7):
        history.append(intercept + sum(w * x for w, x in zip(weights, history[-4:])))
    got = [r["predicted"] for r in forecast.forecast(df, weights, intercept, digits=9).orderBy("step").collect()]
    assert got == pytest.approx(history[-7:], abs=1e-8)


def test_short_series_are_left_out(spark):
    _, df = walk(spark, 9)
    assert forecast.forecast(df, [0.1] * 10, 0.0).count() == 0


def test_target_estimates(spark):
    layout = "Ticker string, Date date, Close double, Returns_1d double"
    days = [START + datetime.timedelta(days=i) for i in range(2)]
    rows = [("up", days[0], 100.0, None), ("up", days[1], 110.0, 0.1), ("down", days[0], 100.0, None),
            ("down", days[1], 90.0, -0.1), ("over", days[0], 100.0, None), ("over", days[1], 300.0, 2.0),
            ("near", days[0], 100.0, None), ("near", days[1], 199.0, 0.99)]
    out = forecast.days_to_target(spark.createDataFrame(rows, layout), 200.0, series=BARS).collect()
    assert {r["Ticker"]: (r["days"], r["status"]) for r in out} == {
        "up": (8, "rising"), "down": (None, "not rising"), "over": (None, "reached"), "near": (1, "rising"),
    }
    steps = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, 1.0), ("b", 2, 6.0), ("c", 1, 1.0)], "Ticker string, step int, predicted double"
    )
    hits = {r["Ticker"]: (r["first_step"], r["status"]) for r in forecast.first_hit(steps, 5.0).collect()}
    assert hits == {"a": (1, "already"), "b": (2, "reached"), "c": (None, "not reached")}
