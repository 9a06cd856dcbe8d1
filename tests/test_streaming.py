"""Replayed streams against the same computation on a table; late rows; repeated batches."""

import datetime
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from candlewick.schemas import TICK
from candlewick.streaming import ticks as tk

ONCE = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)
KEYS = ["window_start", "window_end", "ticker"]


def tick(seconds, ticker="A", price=1.0):
    stamp = (START + datetime.timedelta(seconds=seconds)).isoformat()
    return json.dumps({"timestamp": stamp, "ticker": ticker, "open": price, "high": price + 1, "low": price - 1,
                       "close": price, "volume": 3})


def arrive(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def stream(spark, folder):
    return tk.accepted(tk.read_ticks(spark, {"path": str(folder)}, fmt="text"))


def drain(query):
    query.awaitTermination()
    return query


@pytest.fixture()
def folders(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    return source, str(tmp_path / "out"), str(tmp_path / "ck")


def rows(df):
    return sorted(map(tuple, df.select(*KEYS, "avg_close", "max_close", "min_close", "avg_open", "total_volume").collect()))


def test_update_mode_ends_with_one_row_per_window(spark, folders):
    source, out, ck = folders
    rng = random.Random(1)
    lines = [tick(i * 37, rng.choice("ABC"), float(rng.randint(1, 90))) for i in range(400)]
    for part in range(4):
        arrive(source, f"{part}.json", lines[part * 100:(part + 1) * 100])
        drain(tk.start_sink(tk.tick_windows(stream(spark, source)), out, ck, trigger=ONCE))
    stored = spark.read.parquet(out)
    whole = tk.tick_windows(tk.accepted(tk.parse_ticks(spark.createDataFrame([(x,) for x in lines], "value string"))))
    assert stored.count() > whole.count()
    assert rows(tk.upsert_latest(stored)) == rows(whole)
    assert {str(r["dt"]) for r in stored.select("dt").distinct().collect()} == {"2024-01-01"}


def test_late_ticks_are_dropped_and_counted(spark, folders, tmp_path):
    """Single ticks: what the windows lose is what the audit counts, and what it keeps."""
    source, out, ck = folders
    audit, kept = str(tmp_path / "audit"), str(tmp_path / "kept")

    def run():
        drain(tk.start_sink(tk.tick_windows(stream(spark, source)), out, ck, mode="append", trigger=ONCE))
        drain(tk.start_late_audit(stream(spark, source), audit, ck + "-audit", trigger=ONCE, keep=kept))

    arrive(source, "0.json", [tick(s, price=2.0) for s in (3600, 7200)])
    run()
    assert tuple(tk.late_ticks(tk.late_batches(spark, audit)).first()) == (2, 0, 1)
    # The watermark is 6600 s: the window of 6300 s ended at it, that of 6301 s too, that of 6600 s did not.
    arrive(source, "1.json", [tick(60, price=9.0), tick(61, price=9.0), tick(6301, price=9.0), tick(6600, price=3.0), tick(10_000, price=2.0)])
    run()
    assert tuple(tk.late_ticks(tk.late_batches(spark, audit)).first()) == (7, 3, 2)
    assert spark.read.parquet(out).filter("max_close = 9.0").count() == 0
    assert {r["close"] for r in spark.read.parquet(kept).collect()} == {9.0}
    assert spark.read.parquet(kept).count() == 3
    assert tk.late_ticks(tk.late_batches(spark, audit).limit(0)).first()["n_late"] == 0


def test_late_ticks_of_many_batches(spark, folders):
    """More batches than progress reports are kept; one is repeated from its checkpoint."""
    source, out, ck = folders
    newest, late, n = None, 0, 0
    rng = random.Random(4)
    for part in range(110):
        times = [part * 600 - rng.choice([0, 0, 300, 900, 4000]) for _ in range(3)]
        arrive(source, f"{part:03}.json", [tick(t) for t in times])
        os.utime(source / f"{part:03}.json", (1_700_000_000 + part, 1_700_000_000 + part))
        late += sum((t // 300 + 1) * 300 <= newest - 600 for t in times) if newest is not None else 0
        newest = max(times) if newest is None else max(newest, *times)
        n += len(times)
    one_by_one = tk.accepted(tk.read_ticks(spark, {"path": str(source), "maxFilesPerTrigger": "1"}, fmt="text"))
    drain(tk.start_late_audit(one_by_one, out, ck, trigger=ONCE))
    assert late > 20
    assert tuple(tk.late_ticks(tk.late_batches(spark, out)).first()) == (n, late, 110)


def test_closed_days_are_compacted(spark, folders, tmp_path):
    source, out, ck = folders
    closed = str(tmp_path / "closed")
    rng = random.Random(2)
    lines = [tick(i * 600 + rng.randint(0, 500), rng.choice("AB"), float(rng.randint(1, 90))) for i in range(500)]
    whole = rows(tk.tick_windows(tk.accepted(tk.parse_ticks(spark.createDataFrame([(x,) for x in lines], "value string")))))
    for part in range(5):
        arrive(source, f"{part}.json", lines[part * 100:(part + 1) * 100])
        drain(tk.start_sink(tk.tick_windows(stream(spark, source)), out, ck, trigger=ONCE, rows_per_file=1000))
    day = datetime.date(2024, 1, 1)
    assert tk.closed_days(spark, str(tmp_path / "none")) == []
    days = tk.closed_days(spark, out)
    assert days == [day, day + datetime.timedelta(1), day + datetime.timedelta(2)]  # ticks end on January 4
    assert rows(tk.read_windows(spark, out, closed)) == whole
    # A day that was moved, but whose updates are still there, is read once.
    shutil.copytree(f"{out}/dt={day}", str(tmp_path / "left"))
    assert tk.compact_days(spark, out, closed, days[:1]) == days[:1]
    shutil.copytree(str(tmp_path / "left"), f"{out}/dt={day}")
    assert rows(tk.read_windows(spark, out, closed)) == whole
    assert tk.compact_days(spark, out, closed, days) == days[1:]
    assert not os.path.exists(f"{out}/dt={day}") and rows(tk.read_windows(spark, out, closed)) == whole
    files = lambda d: [f for f in os.listdir(f"{closed}/dt={d}") if f.endswith(".parquet")]
    assert [len(files(d)) for d in days] == [1, 1, 1]
    assert sorted(x for x in os.listdir(closed) if not x.startswith("_")) == [f"dt={d}" for d in days]
    # More bytes, more files.
    again = str(tmp_path / "again")
    shutil.copytree(str(tmp_path / "left"), f"{tmp_path}/updates/dt={day}")
    tk.compact_days(spark, f"{tmp_path}/updates", again, [day], file_bytes=4000)
    assert len([f for f in os.listdir(f"{again}/dt={day}") if f.endswith(".parquet")]) > 1


def test_only_asked_days_are_read(spark, folders, tmp_path):
    source, out, ck = folders
    arrive(source, "0.json", [tick(i * 3600) for i in range(100)])
    drain(tk.start_sink(tk.tick_windows(stream(spark, source)), out, ck, trigger=ONCE))
    day = datetime.date(2024, 1, 2)
    some = tk.upsert_latest(spark.read.parquet(out), since=day, until=day)
    assert some.count() == 24
    assert {r["d"] for r in some.select(F.to_date("window_start").alias("d")).distinct().collect()} == {day}
    assert "PartitionFilters: [isnotnull(dt" in some._jdf.queryExecution().executedPlan().toString()
    tk.compact_days(spark, out, f"{out}-closed", [day])
    found = tk.read_windows(spark, out, f"{out}-closed", since=day, until=day + datetime.timedelta(1))
    assert found.count() == 48
    assert all("dt=2024-01-02" in f or "dt=2024-01-03" in f for f in found.inputFiles())
    with pytest.raises(FileNotFoundError):
        tk.read_windows(spark, out, f"{out}-closed", since=datetime.date(2030, 1, 1))


def test_a_repeated_batch_is_stored_once(spark, folders):
    """The sink runs its batch function again after a failure; the result must not double."""
    source, out, ck = folders
    arrive(source, "0.json", [tick(s) for s in range(0, 1200, 30)])
    windows = tk.tick_windows(stream(spark, source))
    drain(tk.start_sink(windows, out, ck, trigger=ONCE))
    first = spark.read.parquet(out).count()
    drain(tk.start_sink(windows, out, ck + "-again", trigger=ONCE))
    assert spark.read.parquet(out).count() == first


def test_malformed_rows_are_kept_apart(spark):
    lines = [tick(0), "{broken", "not json", tick(1).replace("2024-01-01T", "day one "), "null", "[]",
             '{"ticker": 5, "timestamp": "2024-01-01T00:00:00"}']
    parsed = tk.parse_ticks(spark.createDataFrame([(x,) for x in lines], "value string"), TICK)
    good, bad = tk.accepted(parsed), tk.rejected(parsed)
    assert good.count() + bad.count() == len(lines)
    found = {r["value"]: r["reject"] for r in bad.collect()}
    assert found["{broken"] == "malformed" and found["not json"] == "malformed"
    assert "bad_time" in found.values()
    assert good.first()["event_time"] == START


def test_state_on_disk(spark, folders):
    source, out, ck = folders
    arrive(source, "0.json", [tick(s) for s in range(0, 600, 60)])
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        tk.use_rocksdb_state(spark)
        drain(tk.start_sink(tk.tick_windows(stream(spark, source)), out, ck, trigger=ONCE))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert spark.read.parquet(out).agg(F.sum("total_volume")).first()[0] == 30


def test_tick_features_have_neutral_constants(spark):
    layout = "open double, high double, low double, close double, volume long"
    df = spark.createDataFrame([(2.0, 3.0, 1.0, 4.0, 7), (0.0, 1.0, 0.0, 1.0, None), (None, None, None, None, 1)], layout)
    got = tk.tick_features(df).select("Price_Range_Pct", "Close_Open_Ratio", "RSI", "Volume", "Returns_1d").collect()
    assert [tuple(r) for r in got] == [(1.0, 2.0, 50.0, 7.0, 0.0), (100.0, 100.0, 50.0, 0.0, 0.0), (0.0, 0.0, 50.0, 1.0, 0.0)]
