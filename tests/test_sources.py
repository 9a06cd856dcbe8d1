"""Sources, sinks, payloads, logs and joins on tiny inputs."""

import datetime
import json
import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from candlewick.functions import scalar as s
from candlewick.operators import joins, monitor, series, summary
from candlewick.schemas import BAR, RAW_BAR
from candlewick.session import scratch_path, shared_dir
from candlewick.sources import files, sinks
from candlewick.sources.catalog import register_tables

HEADER = ",".join(BAR.fieldNames())
LINES = ["2024-01-01,BBCA,Bank,1.0,2.0,0.5,1.5,100,0.5,50.0", "2024-01-02,BBCA,,x,2.0,0.5,,100,0.5,50.0"]


def put(path, text, age=0):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def test_bars_from_csv(spark, tmp_path):
    put(tmp_path / "a.csv", "\n".join([HEADER, *LINES]))
    rows = files.read_bars(spark, str(tmp_path)).orderBy("Date").collect()
    assert rows[0]["Close"] == 1.5 and rows[0]["Date"] == datetime.date(2024, 1, 1)
    assert rows[1]["Open"] is None and rows[1]["Close"] is None and rows[1]["Nama_Saham"] is None
    raw = files.read_bars(spark, str(tmp_path), RAW_BAR)
    assert raw.filter("Open = 'x'").count() == 1


def test_a_wrong_header_is_an_error(spark, tmp_path):
    swapped = HEADER.replace("Open,High", "High,Open")
    put(tmp_path / "a.csv", "\n".join([swapped, *LINES]))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_bars(spark, str(tmp_path)).collect()


def test_newest_runs_are_folders(spark, tmp_path):
    for run, age in (("r1", 30), ("r2", 20), ("r3", 10)):
        for part in ("p=1", "p=2"):
            put(tmp_path / "runs" / run / part / "f.csv", f"{HEADER}\n{LINES[0].replace('BBCA', run)}", age)
    paths = files.latest_paths(spark, str(tmp_path / "runs"), 2, ".csv", by="run")
    assert [os.path.basename(p) for p in paths] == ["r3", "r2"]
    got = files.latest_files(spark, str(tmp_path / "runs"), 1, ".csv", RAW_BAR, "csv", by="run")
    assert [r["Ticker"] for r in got.collect()] == ["r3", "r3"]


def test_prefix_and_newest_files(spark, tmp_path):
    for name, age in (("old", 50), ("mid", 20), ("new", 1)):
        put(tmp_path / "raw" / f"{name}.csv", f"{HEADER}\n{LINES[0].replace('BBCA', name.upper())}", age)
    root = str(tmp_path / "raw")
    assert files.read_prefix(spark, root).select("_source_file").distinct().count() == 3
    got = files.latest_files(spark, root, 2, ".csv", RAW_BAR, "csv")
    assert {r["Ticker"] for r in got.collect()} == {"MID", "NEW"}
    with pytest.raises(FileNotFoundError):
        files.latest_files(spark, root, 2, ".parquet")


def test_inventory(spark, tmp_path):
    put(tmp_path / "lake" / "raw" / "a.csv", "x" * 2048)
    put(tmp_path / "lake" / "raw" / "deep" / "b.csv", "x" * 1024)
    put(tmp_path / "lake" / "models" / "m.bin", "x" * 100)
    put(tmp_path / "lake" / "other" / "z.bin", "x")
    rows = files.file_inventory(spark, str(tmp_path / "lake"), ["raw", "models"]).collect()
    assert {r["prefix"]: (r["n_files"], r["size_kb"]) for r in rows} == {"raw": (2, 3.0), "models": (1, 0.1)}


def test_single_documents(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps({"x": 1, "y": {"z": "q"}}, indent=2))
    rows = files.read_docs(spark, str(tmp_path), "x long, y struct<z:string>").collect()
    assert [(r["x"], r["y"]["z"]) for r in rows] == [(1, "q")]


def test_line_protocol_escapes(spark):
    layout = "tag string, msg string, n long, v double, ts timestamp"
    ts = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a b,c=d", 'say "hi"', 5, 1.5, ts), ("", None, None, 2.0, ts), ("x", None, None, None, ts)], layout)
    got = {r["value"] for r in sinks.to_line_protocol(df, "m", ["tag"], ["msg", "n", "v"]).collect()}
    nanos = "1704067200000000000"
    assert got == {rf'm,tag=a\ b\,c\=d msg="say \"hi\"",n=5i,v=1.5 {nanos}', f"m v=2.0 {nanos}"}


def test_bulk_text_drops_nulls(spark):
    df = spark.createDataFrame([("r1", "hello", None)], "id string, msg string, code long")
    action, doc = sinks.to_bulk_ndjson(df, "logs", "id").first()["value"].split("\n")
    assert json.loads(action) == {"index": {"_index": "logs", "_id": "r1"}}
    assert json.loads(doc) == {"id": "r1", "msg": "hello"}


def test_log_documents(spark, tmp_path):
    put(tmp_path / "logs" / "a.json", json.dumps({"timestamp": "2024-01-02T03:04:05", "level": "FATAL", "flow": "batch",
                                                  "status": "failed", "error_code": 7}))
    put(tmp_path / "logs" / "b.json", "[1, 2]")
    put(tmp_path / "logs" / "c.txt", "plain " * 200)
    put(tmp_path / "logs" / "d.json", json.dumps({"severity": "", "rows": 3}))
    rows = monitor.normalize_docs(files.read_text_docs(spark, str(tmp_path / "logs"))).collect()
    found = {os.path.basename(r["source_file"]): r for r in rows}
    assert set(found) == {"a.json", "c.txt", "d.json"}
    a, c, d = found["a.json"], found["c.txt"], found["d.json"]
    assert (a["severity"], a["pipeline"], a["message"], a["error_code"]) == ("FATAL", "batch", "failed", 7)
    assert a["@timestamp"] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert (c["severity"], c["pipeline"], len(c["message"])) == ("INFO", "unknown", 500)
    assert d["severity"] == "INFO" and json.loads(d["message"]) == {"severity": "", "rows": 3}


def test_whole_log_documents(spark, tmp_path):
    """Every field reaches the bulk lines with its type; what a plain JSON reader makes of a document counts."""
    texts = {
        "whole": '{"level": "FATAL", "n": 1.5, "big": 12345678901234567890, "deep": {"a": [1, {"b": null}]}, "none": null,'
                 ' "flag": true, "text": "12", "quote\\"d": "é\\n", "run_id": 7}',
        "twice": '{"severity": "INFO", "n": 1, "severity": "FATAL", "n": 2, "note": "2x", "duration_ms": 5, "list": [1, 2]}',
        "inside": '{"severity": "FATAL", "deep": {"a": 1, "a": 2}, "n": 3, "text": "4", "none": null}',
        "behind": '{"severity": "FATAL"} more', "two": '{"a": 1} {"b": 2}', "comma": '{"a": 1},{"b": 2}',
        "cut": '{"severity": "FATAL", "n": ', "list": "[1, 2]", "number": "7", "null": "null", "empty": "  ", "object": "{}",
    }
    for name, text in texts.items():
        put(tmp_path / "logs" / name, text)
    logs = monitor.normalize_docs(files.read_text_docs(spark, str(tmp_path / "logs")))
    found = {os.path.basename(r["source_file"]): r for r in logs.collect()}
    assert set(found) == set(texts) - {"list", "number", "null"}
    rejects = {name: r["reject"] for name, r in found.items() if r["reject"]}
    assert rejects == {"twice": "duplicate_key", "inside": "duplicate_key", **dict.fromkeys(["behind", "two", "comma", "cut", "empty"], "not_json")}
    assert {n for n, r in found.items() if r["severity"] == "FATAL"} == {"whole", "twice", "inside"}
    assert found["twice"]["duration_ms"] == 5 and found["whole"]["run_id"] == "7"
    bulk = sinks.to_bulk_documents(logs, "i", F.regexp_extract("source_file", "[^/]+$", 0), monitor.COMMON)
    docs = {json.loads(a)["index"]["_id"]: json.loads(d) for a, d in (r["value"].split("\n") for r in bulk.collect())}
    for name in ("whole", "twice", "object"):
        want = {k: v for k, v in json.loads(texts[name]).items() if v is not None and k not in monitor.COMMON}
        assert {k: v for k, v in docs[name].items() if k not in monitor.COMMON} == want, name
    assert docs["inside"]["n"] == 3 and docs["inside"]["text"] == "4" and docs["inside"]["deep"] == '{"a":1,"a":2}'
    assert all(set(monitor.COMMON) <= set(d) for d in docs.values())
    assert docs["cut"]["message"] == texts["cut"] and "fields" not in docs["cut"]


def test_freshness_that_holds(spark):
    at = lambda minutes: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)
    rows = [("a", at(0), 1, "completed"), ("a", at(1444), 2, "completed"), ("a", at(1500), 3, "failed"), ("a", at(2890), 4, "completed"),
            ("b", at(0), 5, "completed"), ("c", at(0), 6, "failed"), (None, at(100), 7, "completed")]
    runs = spark.createDataFrame(rows, "job string, ts timestamp_ntz, n long, status string")
    for split in (None, series.Split("hour"), series.Split("day")):
        held = monitor.stale_periods(runs, series.Series(("job",), "ts", ("n",), split), now=F.lit(at(3000)))
        found = {r["job"]: (r["last_success"], r["firing_since"], r["resolved_at"]) for r in held.collect()}
        # 1444 minutes are over a day, but not for five minutes.
        assert found == {"a": (at(1444), at(2889), at(2890)), "b": (at(0), at(1445), None), None: (at(100), at(1545), None)}


@pytest.mark.parametrize("block", ["128m", "64"])
def test_heads_of_text_files(spark, tmp_path, block):
    texts = {
        "end": "\n", "short": "one\n", "open": "one\ntwo", "blank": "\n\n\nx\n",
        "long": "".join(f"line {i} é\n" for i in range(4000)), "wide": "w" * 9000, "windows": "a\r\nb\r\n",
        "exact": "y" * 49 + "\n" + "z" * 10, "empty": "", "sp ace%20": "",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.log").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = files.read_text_heads(spark, str(tmp_path), 50).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {os.path.basename(unquote(r["source_file"]))[:-4]: r["content"] for r in rows}
    assert got == {name: text[:50] for name, text in texts.items()}


def test_text_logs_by_path(spark, tmp_path):
    for area in ("batch", "streaming", "ml", "misc"):
        put(tmp_path / "logs" / area / "run.log", f"line of {area}")
    docs = files.read_text_docs(spark, str(tmp_path / "logs"), "*.log")
    below = docs.withColumn("source_file", F.regexp_extract("source_file", r"logs/(.*)$", 1))
    got = {r["message"].split()[-1]: r["pipeline"] for r in monitor.normalize_text_logs(below).collect()}
    assert got == {"batch": "batch", "streaming": "stream", "ml": "ml", "misc": "unknown"}


def test_inhibition(spark):
    rows = [("x", "j1", "critical"), ("x", "j1", "warning"), ("x", "j2", "warning"), ("y", None, "critical"),
            ("y", None, "warning"), ("x", "j1", "info"), ("x", "j1", None)]
    out = joins.inhibit(spark.createDataFrame(rows, "alertname string, job string, severity string"))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [
        rows[0], rows[2], rows[3], rows[5], rows[6]]))


def test_freshness(spark):
    now = datetime.datetime(2024, 1, 10)
    rows = [("old", "completed", now - datetime.timedelta(days=2)), ("old", "failed", now),
            ("edge", "completed", now - datetime.timedelta(days=1)), ("never", "failed", now)]
    runs = spark.createDataFrame(rows, "pipeline string, status string, timestamp timestamp")
    out = monitor.freshness(runs, now=F.lit(now)).collect()
    assert [(r["pipeline"], r["age_seconds"]) for r in out] == [("old", 172_800.0)]


def test_every_key_is_a_group(spark):
    rows = [(0, 1.0), (0, 3.0), (-1, 5.0), (4, 7.0), (20_000, 8.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r["g"], r["v"]): r["m"] for r in joins.with_group_means(df, "g", {"v": "m"}).collect()}
    assert got == {(0, 1.0): 2.0, (0, 3.0): 2.0, (-1, 5.0): 5.0, (4, 7.0): 7.0, (20_000, 8.0): 8.0, (None, 9.0): None}


def test_latest_per_key_with_ties(spark):
    day = datetime.date(2024, 1, 1)
    rows = [("A", day, 1, 5.0), ("A", day, 2, 4.0), ("A", day, 3, None)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, seq int, Close double")
    assert summary.latest_per_key(df, columns=["Close"], ties=["seq"]).first()["Close"] == 4.0


def test_latest_per_key_skips_nulls(spark):
    day = datetime.date
    rows = [("A", day(2024, 1, 1), 1.0, 2.0), ("A", day(2024, 1, 2), 4.0, None), ("A", day(2024, 1, 3), None, None)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, Open double, Close double")
    row = summary.latest_per_key(df, columns=["Open", "Close"]).first()
    assert (row["Open"], row["Close"], row["Change"], row["Change_Pct"]) == (4.0, 2.0, -2.0, -50.0)


@pytest.mark.parametrize("expression, wanted", [
    (lambda: s.normalize_symbol(F.lit("BBCA.JK")), "BBCA"),
    (lambda: s.normalize_symbol(F.lit("^JKSE")), "JKSE"),
    (lambda: s.first_non_empty(F.lit(""), F.lit(None), F.lit("x"), default="d"), "x"),
    (lambda: s.first_non_empty(F.lit(""), default="d"), "d"),
    (lambda: s.classify(F.lit("logs/stream/batch.log"), [("batch", "b"), ("stream", "s")], "u"), "b"),
    (lambda: s.bands(F.lit(3), [(5, "yellow"), (2, "green")], "red"), "green"),
    (lambda: s.bands(F.lit(None).cast("int"), [(5, "yellow")], "red"), None),
    (lambda: s.bands(F.lit(5), [(5, "over")], "under", inclusive=False), "under"),
    (lambda: s.rsi_label(F.lit(70)), "neutral"),
    (lambda: s.rsi_label(F.lit(29.9)), "oversold"),
    (lambda: s.floor_clip(F.lit(0.0), 1.0, 0.01), 0.01),
    (lambda: s.floor_clip(F.lit(None).cast("double"), 1.0, 0.01), 1.0),
    (lambda: s.finite(F.lit(float("-inf"))), None),
    (lambda: s.ratio(F.lit(1.0), F.lit(0.0)), None),
    (lambda: s.parse_date(F.lit("2024-13-01")), None),
    (lambda: s.truncate(F.lit("abcdef"), 3), "abc"),
])
def test_scalars(spark, expression, wanted):
    assert spark.range(1).select(expression().alias("x")).first()["x"] == wanted


def test_packed_order_sorts_like_the_pair(spark):
    base = datetime.datetime(1969, 12, 31, 23, 59, 59)
    pairs = [(base, 5), (base, 10**17), (base + datetime.timedelta(microseconds=1), 0),
             (datetime.datetime(2200, 1, 1), 1), (datetime.datetime(1970, 1, 1), 3)]
    df = spark.createDataFrame(pairs, "t timestamp, n long").withColumn("p", s.packed_order("t", "n"))
    assert [r["p"] for r in df.orderBy("t", "n").collect()] == [r["p"] for r in df.orderBy("p").collect()]
    assert df.filter("p IS NULL").count() == 0


def test_views_and_buckets(spark, tmp_path):
    spark.range(10).withColumn("k", F.col("id") % 3).write.parquet(str(tmp_path / "t.parquet"))
    assert register_tables(spark, str(tmp_path), ["t"], prefix="v_") == ["v_t"]
    assert spark.sql("SELECT count(*) FROM v_t").first()[0] == 10


def test_shared_folder_is_the_named_one(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    try:
        spark.conf.set("spark.checkpoint.dir", "/some/shared/place")
        assert shared_dir(spark) == "/some/shared/place"
        assert scratch_path(spark, "x").startswith("/some/shared/place/")
    except Exception as e:  # a static setting cannot be changed on a running session
        assert "CANNOT_MODIFY" in str(e)
    finally:
        try:
            spark.conf.set("spark.checkpoint.dir", before) if before else spark.conf.unset("spark.checkpoint.dir")
        except Exception:
            pass
