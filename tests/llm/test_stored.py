"""Tables that operators write to the shared folder on their way."""

import os

from pyspark.sql import functions as F

from candlewick.llm import graph, jaccard


def shuffle_files(spark):
    """Shuffle data files in Spark's own folders on this machine."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 10).alias("k")).count()
    stored = graph._stored(rows, "counts")
    assert not shuffle_files(spark) - before
    assert sorted((r.k, r["count"]) for r in stored.collect()) == [(k, 100) for k in range(10)]


def test_settings_of_the_session_stay(spark):
    before = spark.conf.get(graph._CLEANUP)
    stored = graph._stored(spark.range(3), "three")
    assert spark.conf.get(graph._CLEANUP) == before
    graph._dropped(stored)
    assert not os.path.exists(stored._stored_at.removeprefix("file:"))


def test_sets_are_made_after_the_shuffle_of_texts(docs_of, monkeypatch):
    """The whole texts are joined in a query of its own, so both shuffles are never on disk together."""
    plans, stored = {}, jaccard._stored

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(jaccard, "_stored", noted)
    found = jaccard.similar_groups(docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k l"), (2, "a b c d e f")]))
    assert {(r.id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 3)}
    assert "Join" not in plans["sets"]


def test_buckets_need_no_shuffle_and_leave_nothing(spark):
    """Rows of a key are in one bucket, so grouping and joining by it moves them no more."""
    before, tables = shuffle_files(spark), spark.catalog.listTables()
    rows = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 10).alias("k")).count()
    dealt = graph._dealt(rows, "counts", "k")
    assert not shuffle_files(spark) - before
    again = dealt.groupBy("k").agg(F.sum("count").alias("n"))
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.n) for r in again.collect()) == [(k, 100) for k in range(10)]
    graph._dropped(dealt)
    assert not os.path.exists(dealt._stored_at.removeprefix("file:"))
    assert spark.catalog.listTables() == tables
    empty = graph._dealt(rows.where("k < 0"), "none", "k")
    assert empty.count() == 0
    graph._dropped(empty)
