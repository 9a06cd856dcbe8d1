"""What the optimizer makes of the operators: shuffles, pushed filters, pruned columns, no Python."""

import re

import pytest
from pyspark.sql import functions as F

from candlewick.operators import cluster, dedup, features, filters, joins, quality, summary
from candlewick.operators import series as sr
from candlewick.plans import QUERIES
from candlewick.plans import fixtures as fx
from candlewick.sources.catalog import save_bucketed

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bars")
    fx.bars(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("operator", [features.ml_features, features.etl_features])
def test_features_shuffle_and_sort_once(stored, operator):
    text = plan(operator(stored))
    assert exchanges(text) == ["hashpartitioning"]
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_bucketed_bars_need_no_shuffle(spark, stored, tmp_path):
    layout = save_bucketed(stored, "bucketed_bars", str(tmp_path / "bucketed"), file_bytes=20_000)
    try:
        assert layout.buckets > 1 and layout.hot is None
        df = features.ml_features(spark.table("bucketed_bars"))
        assert exchanges(plan(df)) == []
        assert df.count() == features.ml_features(stored).count()
        assert save_bucketed(stored, "one_file", str(tmp_path / "one")).buckets == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_bars")
        spark.sql("DROP TABLE IF EXISTS one_file")


def test_entities_larger_than_a_file_are_salted(spark, tmp_path):
    """One entity holds a third of the rows; the others and their windows stay as they are."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.col("id").alias("n"), F.repeat(F.lit("x"), 20).alias("text"),
    )
    layout = save_bucketed(rows, "salted", str(tmp_path / "salted"), ("k",), file_bytes=40_000)
    try:
        assert layout.hot == "salted_hot" and layout.hot_buckets == 3
        cold, hot = spark.table("salted"), spark.table("salted_hot")
        assert {r["k"] for r in hot.select("k").distinct().collect()} == {"hot"}
        assert sorted(map(tuple, cold.union(hot.drop("_salt")).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
        parts = hot.groupBy("k", "_salt").agg(F.count(F.lit(1)).alias("n"))
        assert exchanges(plan(parts)) == [] and exchanges(plan(cold.groupBy("k").count())) == []
        assert sorted(r["n"] for r in parts.collect())[0] > 800 and parts.count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS salted")
        spark.sql("DROP TABLE IF EXISTS salted_hot")


def test_exact_profile_repeats_no_rows(stored):
    text = plan(quality.profile(stored))
    assert "Expand" not in text and len(re.findall("FileScan", text)) == 2


def test_training_rows_shuffle_once(stored):
    text = plan(sr.chrono_split(sr.sequences(stored)))
    assert exchanges(text) == ["hashpartitioning"]


def test_bars_combine_before_the_shuffle(spark):
    text = plan(fx.bars_many(spark, SF))
    assert "SortAggregate" not in text and "partial_min_by" in text
    assert exchanges(text) == ["hashpartitioning"]


@pytest.mark.parametrize("operator", [
    lambda df: dedup.dedup_newest(df, ["Ticker", "Date"], "Volume"),
    lambda df: summary.tail_n(df, 5),
    lambda df: sr.trailing_streak(df, F.col("Close") > 1),
    lambda df: sr.latest_change(df),
], ids=["dedup", "tail", "streak", "change"])
def test_rank_limit_comes_before_the_shuffle(stored, operator):
    text = plan(operator(stored))
    assert re.search(r"WindowGroupLimit .*Partial", text)
    assert len(exchanges(text)) == 1


def test_split_series_have_no_window_on_the_entity_alone(spark):
    text = plan(QUERIES["point_features"](spark, SF))
    for line in text.splitlines():
        # The only such window runs over one summary row per bucket.
        if "Exchange hashpartitioning(ticker" in line and "_b" not in line.split("Exchange")[1]:
            below = text.split(line, 1)[1]
            assert below.lstrip().split("\n")[0].count("HashAggregate") == 1
    assert "SortAggregate" not in text


def test_cluster_means_carry_no_hint(spark, stored):
    scored = stored.withColumn("Cluster", F.col("Volume") % 4).withColumn("Volatility_5d", F.lit(0.1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unmeasured = plan(joins.enrich_with_cluster_means(scored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in unmeasured and "SortMergeJoin" in unmeasured


def test_filters_reach_the_scan(stored):
    text = plan(filters.filter_symbols(stored, ["2-HIGH"]).select("Close"))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(Ticker,2-HIGH\)", text) or "In(Ticker" in text
    assert "ReadSchema: struct<Ticker:string,Close:double>" in text


def test_whole_symbols_reach_the_scan(stored):
    text = plan(filters.filter_whole_symbol(stored, "^2-HIGH.JK").select("Close"))
    assert "In(Ticker, [" in text and "2-HIGH.JK" in text


def test_time_filter_adds_no_join(spark):
    events = fx.table(spark, SF, "events")
    assert "Join" not in plan(filters.since(events, "ts", "7 days"))


def test_no_python_and_no_cross_join_in_batch_plans(spark):
    streams_and_models = re.compile(r"stream|kafka|foreach|kmeans|model|batch_score|prediction|lag_regression")
    for name, run in QUERIES.items():
        if not streams_and_models.search(name):
            text = plan(run(spark, SF))
            assert "Python" not in text and "InPandas" not in text, name
            assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_inventory_does_not_read_contents(spark):
    text = plan(QUERIES["file_inventory"](spark, SF))
    assert "content" not in text.split("ReadSchema", 1)[1].split("\n")[0]


def test_scoring_stays_in_the_jvm(spark, stored):
    model = cluster.train_clusters(stored, ["Open", "Close"], k=2, restarts=1)
    assert "Python" not in plan(cluster.predict_into(stored, model))


def final_plan(df) -> str:
    """The plan after it ran, with the exchanges that were used again."""
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    text = executed.toString()
    return text.split("== Initial Plan ==")[0]


def row_exchanges(text: str, column: str) -> list[str]:
    """Exchanges that carry whole rows (with ``column``) and are not a second use of another one."""
    lines = text.splitlines()
    found = []
    for i, line in enumerate(lines):
        if re.search(r"[ -]Exchange hashpartitioning", line) and "ReusedExchange" not in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if column in below and "HashAggregate" not in below:
                found.append(line.strip())
    return found


@pytest.fixture()
def measured_joins(spark):
    """Nothing is broadcast, as for tables too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chrono_split_shuffles_rows_once(spark, measured_joins):
    df = sr.chrono_split(fx.points(spark, SF), 0.8, fx.POINTS)
    text = final_plan(df)
    assert len(row_exchanges(text, "value")) == 1
    assert text.count("FileScan") <= 2
    for line in text.splitlines():
        # Alone, the entity deals out nothing but sums of coarse buckets.
        if "Exchange hashpartitioning(_k0" in line and "_bucket" not in line and "_coarse" not in line:
            assert "HashAggregate" in text.split(line, 1)[1].lstrip().split("\n")[0]


def test_windows_over_hot_entities_shuffle_rows_once(spark, measured_joins):
    """Besides the rows themselves only those at the edges of buckets move."""
    df = sr.sequences(fx.points(spark, SF), "value", 60, fx.POINTS)
    text = final_plan(df)
    whole = row_exchanges(text, "value")
    assert len([x for x in whole if "REPARTITION" not in x]) == 1
    assert len([x for x in whole if "REPARTITION" in x]) == 1


@pytest.mark.parametrize("operator", [
    lambda df: sr.longest_streak(df, F.col("value") >= 10, fx.POINTS, 4),
    lambda df: sr.sustained(df, F.col("value") >= 2, "5 minutes", fx.POINTS),
], ids=["streak", "sustained"])
def test_runs_are_summarised_and_never_joined_back(spark, operator, measured_joins):
    text = final_plan(operator(fx.points(spark, SF)))
    assert "Join" not in text
    assert text.count("FileScan") == 1
    assert len(re.findall(r"[ -]Exchange hashpartitioning", text)) == 3  # rows, pieces of buckets, pieces of months
