"""The daily jobs end to end on a small lake."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from candlewick import jobs
from candlewick.operators.quality import flatten_report, read_audit
from candlewick.operators.runs import read_runs
from candlewick.schemas import BAR

DAYS = 160


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two raw files: the second repeats part of the first with corrected closes."""
    root = tmp_path_factory.mktemp("lake")
    rng = random.Random(11)

    def lines(days, shift):
        out = [",".join(BAR.fieldNames())]
        for ticker in ("^JKSE", "BBCA.JK", "TLKM.JK"):
            price = 5000.0
            for i in days:
                price += rng.uniform(-40, 60)
                o, c = price, price + rng.uniform(-20, 20) + shift
                date = datetime.date(2024, 1, 1) + datetime.timedelta(days=i)
                out.append(f"{date},{ticker},x,{o:.2f},{max(o, c) + 5:.2f},{min(o, c) - 5:.2f},{c:.2f},{1000 + i},0,0")
        return "\n".join(out) + "\n"

    import os

    (root / "raw").mkdir()
    (root / "raw" / "a.csv").write_text(lines(range(DAYS), 0))
    os.utime(root / "raw" / "a.csv", (1_700_000_000, 1_700_000_000))
    (root / "raw" / "b.csv").write_text(lines(range(DAYS - 10, DAYS), 1))
    return root


def test_newest_copy_of_each_bar_is_used(spark, lake):
    bars = jobs.load_bars(spark, str(lake / "raw"))
    assert bars.count() == 3 * DAYS
    assert {r[0] for r in bars.select("Ticker").distinct().collect()} == {"JKSE", "BBCA", "TLKM"}


def test_etl(spark, lake):
    out = jobs.etl(spark, str(lake / "raw"), str(lake / "etl"), stamp="run1", codec="gzip")
    rows = spark.read.parquet(out)
    assert rows.count() == 3 * DAYS and "SMA_30" in rows.columns
    jobs.publish_bars(spark, str(lake / "raw"), str(lake / "published"))
    named = spark.read.option("header", True).csv(str(lake / "published"))
    assert named.filter("Ticker = 'BBCA' AND Nama_Saham = 'Bank Central Asia'").count() == DAYS


def test_features_to_scores(spark, lake):
    features, store = str(lake / "features"), str(lake / "store")
    for stamp in ("1", "2"):
        jobs.engineer(spark, str(lake / "raw"), features, stamp=stamp)
    jobs.train(spark, features, store, k=3, restarts=2)
    analysis = {r["Ticker"]: r for r in jobs.score(spark, features, store, str(lake / "scored")).collect()}
    scored = spark.read.parquet(str(lake / "scored"))
    assert scored.count() == 3 * (DAYS - 5) and scored.filter("Cluster IS NULL").count() == 3 * 14
    assert len(analysis["JKSE"]["recent_closes"]) == 5
    assert sum(analysis["JKSE"]["distribution"].values()) == DAYS - 19
    assert read_runs(spark, f"{store}/runs").filter("pipeline = 'clusters'").count() == 1


def test_forecast(spark, lake):
    hits = jobs.predict(spark, str(lake / "raw"), str(lake / "store2"), str(lake / "forecasts"), seq_len=10)
    assert hits.count() == 1
    doc = json.loads(spark.read.text(str(lake / "forecasts")).first()["value"])
    assert doc["Ticker"] == "JKSE" and len(doc["predictions"]) == 7 and doc["seq_len"] == 10
    assert min(doc["predictions"]) == str(datetime.date(2024, 1, 1) + datetime.timedelta(days=DAYS))
    row = jobs.estimate(spark, str(lake / "raw"), target=5100.0).first()
    assert row["max_streak"] >= row["streak"] >= 0


def test_checks(spark, lake):
    score = jobs.check(spark, str(lake / "raw"), str(lake / "reports"), str(lake / "audit")).first()
    assert score["total_rows"] == 3 * DAYS + 30 and score["quality_score"] == 100.0
    assert read_audit(spark, str(lake / "audit")).first()["action"] == "data_quality_check"
    entry = "struct<dtype:string,total:long,unique_count:long,type_errors:long>"
    layout = f"dataset string, columns map<string,{entry}>"
    flat = flatten_report(spark.read.schema(layout).json(str(lake / "reports")))
    found = {r["column"]: r for r in flat.collect()}
    assert set(found) == set(BAR.fieldNames()) and found["Close"]["type_errors"] == 0


def test_masking(spark, lake):
    people = lake / "people.csv"
    people.write_text(
        "user_id,nama_lengkap,email,no_telepon,alamat,saldo_investasi,risk_profile\n"
        '1,Siti Rahmawati,siti.rahma@yahoo.com,082345678901,"Jl. Sudirman No. 45, Bandung",100000000,aggressive\n'
    )
    jobs.mask(spark, str(people), str(lake / "masked"), str(lake / "masking"))
    done = json.loads(spark.read.text(str(lake / "masking")).first()["value"])
    assert done["n_rows"] == 1 and done["original_file"] == str(people) and "timestamp" in done
    assert {f["field"]: (f["stored_as"], f["n_changed"]) for f in done["fields_masked"]}["saldo_investasi"] == ("saldo_investasi_kategori", 1)
    row = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(str(lake / "masked")).first()
    assert row["email"] == "s****a@yahoo.com" and row["saldo_investasi_kategori"] == "> 100 juta"


def test_log_export(spark, lake):
    (lake / "docs").mkdir()
    (lake / "docs" / "a.json").write_text('{"status": "completed", "pipeline": "batch", "rows": 5, "tags": {"a": [1]}}')
    (lake / "logs" / "stream").mkdir(parents=True)
    (lake / "logs" / "stream" / "run.log").write_text("done")
    jobs.export_logs(spark, str(lake / "docs"), str(lake / "logs"), str(lake / "bulk"))
    lines = [r["value"] for r in spark.read.text(str(lake / "bulk")).collect()]
    docs = [json.loads(x) for x in lines if '"index"' not in x]
    assert len(lines) == 4 and {d["message"] for d in docs} == {"completed", "done"}
    assert [(d["rows"], d["tags"]) for d in docs if "rows" in d] == [(5, {"a": [1]})]


def test_command_line(lake, spark, capsys):
    jobs.main(["estimate", "--raw", str(lake / "raw"), "--target", "5100"])
    assert "max_streak" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.main(["etl", "--raw", "x"])
    assert spark.range(1).select(F.lit(1)).first()[0] == 1
