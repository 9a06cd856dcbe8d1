"""What must hold for any input."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.functions import masking
from candlewick.operators import cluster, features, summary
from candlewick.operators import series as sr
from candlewick.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SERIES = sr.Series(("k",), "ts", ("n",))
START = datetime.datetime(2024, 1, 1)

# Java and Python disagree on whether the four ASCII separators U+001C to U+001F are white space.
words = st.text(st.one_of(st.sampled_from(" ,@\tab\u3000"), st.characters(exclude_categories=["Cs", "Cc"])), max_size=20)

points = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", None]),
        st.integers(0, 400),
        st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
    ),
    min_size=1, max_size=80,
)


@FEW
@given(points, st.sampled_from(["minute", "hour", "day", "month"]))
def test_any_split_gives_the_same_rows(spark, rows, grain):
    data = [(k, START + datetime.timedelta(minutes=7 * m), n, v) for n, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp, n long, value double")
    cut = sr.Series(("k",), "ts", ("n",), sr.Split(grain))

    def run(series):
        out = sr.in_blocks(
            df, series,
            lambda r, w: r.withColumns({
                "m": F.count("value").over(w.rowsBetween(-2, 0)), "next": F.lead("value", 1).over(w),
            }),
            before=3, after=1, fill={"known": F.col("value")},
        )
        streaks = sr.longest_streak(df, F.col("value") > 0, series)
        lasting = sr.sustained(df, F.col("value") > -2, "20 minutes", series)
        return (
            sorted(map(repr, lasting.collect())),
            sorted(map(repr, out.select("k", "ts", "n", "m", "next", "known").collect())),
            sorted(map(repr, streaks.collect())),
        )

    assert run(SERIES) == run(cut)


@FEW
@given(st.lists(words, min_size=1, max_size=40))
def test_masks_follow_the_rules_on_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(
        "t", masking.mask_email("t").alias("email"), masking.mask_name("t").alias("name"),
        masking.mask_phone("t").alias("phone"), masking.mask_address("t").alias("address"),
    ).collect()
    for r in out:
        text = r["t"]
        # A mask never adds characters of the text that were not at its ends.
        assert len(r["phone"]) <= len(text) + 7 and "****" in r["phone"]
        assert r["phone"].startswith(text[:3]) and r["phone"].endswith(text[-3:])
        assert r["email"] is None or ("****" in r["email"] and text.endswith(r["email"][r["email"].rindex("@") :]))
        assert r["name"] == text or r["name"].endswith("***")
        assert "," in text or "*****" in r["address"] or len(text.split()) < 2


@pytest.mark.parametrize("mask, text, masked", [
    (masking.mask_phone, "08123456789", "081****789"),
    (masking.mask_name, "Siti", "Siti"),
    (masking.mask_name, "Budi Agung Santoso", "Budi S***"),
    (masking.mask_email, "no address", None),
    (masking.mask_email, "a@b@c", None),
    (masking.mask_address, "Jalan Merdeka 17,Bandung", "Jalan ***** 17, Bandung"),
    (masking.mask_address, "Jakarta", "Jakarta"),
])
def test_masks_of_known_texts(spark, mask, text, masked):
    assert spark.range(1).select(mask(F.lit(text)).alias("m")).first()["m"] == masked


@pytest.fixture(scope="module")
def bars(spark):
    return fx.bars(spark, SF).cache()


def test_averages_agree_once_full(bars):
    df = features.sma(features.sma(bars, "Close", 7, name="part"), "Close", 7, 7, name="full")
    assert df.filter("full IS NOT NULL AND abs(full - part) > 1e-9").count() == 0
    assert df.filter("full IS NULL").count() == 6 * df.select("Ticker").distinct().count()


def test_streaks_are_bounded(bars):
    hit = F.col("Close") >= fx.TARGET
    both = (
        sr.longest_streak(bars, hit).join(sr.trailing_streak(bars, hit), "Ticker")
        .join(summary.describe_series(bars), "Ticker")
    )
    assert both.count() == 5
    assert both.filter("streak > 20 OR streak > max_streak OR max_streak > n_rows").count() == 0


def test_cluster_counts_add_up(bars):
    rows = features.ml_features(bars)
    scored = cluster.predict_into(rows, cluster.train_clusters(rows, k=3, restarts=1))
    counted = summary.value_counts(scored, "Cluster").agg(F.sum("n")).first()[0]
    assert counted == scored.filter("RSI IS NOT NULL AND SMA_Cross IS NOT NULL").count()
