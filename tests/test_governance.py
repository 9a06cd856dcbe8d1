"""Masking pairs, profile against pandas, duplicates, scores."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.functions import masking
from candlewick.operators import dedup, privacy, quality
from candlewick.schemas import AMOUNT_BANDS, AMOUNT_BELOW, TRADER


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression("v").alias("out")).first()["out"]


@pytest.mark.parametrize("rule, given, wanted", [
    (masking.mask_name, "Siti Rahmawati", "Siti R***"),
    (masking.mask_name, "Budi", "Budi"),
    (masking.mask_name, "  Ana  Maria  Putri ", "Ana P***"),
    (masking.mask_email, "siti.rahma@yahoo.com", "s****a@yahoo.com"),
    (masking.mask_email, "a@x.id", "a****@x.id"),
    (masking.mask_email, "ab@x.id", "a****@x.id"),
    (masking.mask_email, "abc@x.id", "a****c@x.id"),
    (masking.mask_email, "nobody", None),
    (masking.mask_email, "two@at@signs", None),
    (masking.mask_email, "@x.id", None),
    (masking.mask_email, None, None),
    (masking.mask_phone, "082345678901", "082****901"),
    (masking.mask_phone, "08", "08****08"),
    (masking.mask_address, "Jl. Sudirman No. 45, Bandung", "Jl. ***** 45,  Bandung"),
    (masking.mask_address, "Jl. Sudirman No. 45", "Jl. ***** 45"),
    (masking.mask_address, "Rumah, Blok A, Medan", "Rumah,  Blok A,  Medan"),
])
def test_masking(spark, rule, given, wanted):
    assert one(spark, rule, given) == wanted


@pytest.mark.parametrize("amount, wanted", [
    (100_000_000, "> 100 juta"), (99_999_999, "50-100 juta"), (50_000_000, "50-100 juta"), (49_999_999, "< 50 juta"),
])
def test_amount_bands(spark, amount, wanted):
    assert one(spark, lambda c: masking.generalize(c, AMOUNT_BANDS, AMOUNT_BELOW), amount, "long") == wanted


def test_masked_table(spark):
    row = (1, "Siti Rahmawati", "siti.rahma@yahoo.com", "082345678901", "Jl. Sudirman No. 45, Bandung",
           100_000_000, "aggressive")
    out = privacy.mask_table(spark.createDataFrame([row], TRADER))
    assert out.columns == ["user_id", "nama_lengkap", "email", "no_telepon", "alamat", "saldo_investasi_kategori",
                           "risk_profile"]
    assert tuple(out.first()) == (1, "Siti R***", "s****a@yahoo.com", "082****901", "Jl. ***** 45,  Bandung",
                                  "> 100 juta", "aggressive")
    with pytest.raises(ValueError, match="email"):
        privacy.mask_table(out.drop("email"))


def test_long_local_parts_do_not_survive(spark):
    df = spark.range(500).select(F.concat(F.lit("user"), F.col("id"), F.lit("x@mail.com")).alias("email"))
    out = df.select("email", masking.mask_email("email").alias("m"))
    assert out.filter(F.col("m").contains(F.split("email", "@")[0])).count() == 0
    assert out.filter(F.length("m") > F.length("email") + 4).count() == 0


def test_hash_depends_on_salt(spark):
    a, b = (one(spark, lambda c, s=s: masking.hash_pii(c, s), "x") for s in ("one", "two"))
    assert a != b and len(a) == 64


ROWS = [
    ("2024-01-01", "A", "1.5", "10"), ("2024-01-02", "A", "n/a", "11"), ("bad", "A", None, "12"),
    ("2024-01-01", "A", "1.5", "10"), (None, None, None, "x"), (None, None, None, "x"),
]


def test_raw_profile(spark):
    df = spark.createDataFrame(ROWS, "Date string, Ticker string, Close string, Volume string")
    found = {r["column"]: r for r in quality.profile(df).collect()}
    close = found["Close"]
    assert (close["total"], close["null_count"], close["null_pct"], close["unique_count"]) == (3, 3, 50.0, 2)
    assert (close["type_errors"], close["type_error_pct"]) == (1, 16.67)
    assert found["Volume"]["type_errors"] == 2 and found["Date"]["date_parse_errors"] == 1
    assert found["Ticker"]["type_errors"] is None


def test_profile_matches_pandas(spark):
    table = pd.DataFrame({"Close": [1.0, None, 3.5, 3.5, 9.0], "Volume": [1, 2, 2, 4, 5], "Empty": [None] * 5})
    df = spark.createDataFrame(
        [(1.0, 1, None), (None, 2, None), (3.5, 2, None), (3.5, 4, None), (9.0, 5, None)],
        "Close double, Volume long, Empty double",
    )
    found = {r["column"]: r for r in quality.profile(df).collect()}
    for c in ("Close", "Volume"):
        s = table[c]
        assert found[c]["null_count"] == s.isnull().sum() and found[c]["unique_count"] == s.nunique()
        for name, value in {"min": s.min(), "max": s.max(), "mean": s.mean(), "std": s.std()}.items():
            assert abs(found[c][name] - value) < 1e-12
    assert found["Empty"]["min"] is None and found["Empty"]["null_pct"] == 100.0


def test_overall_and_score(spark):
    df = spark.createDataFrame(ROWS, "Date string, Ticker string, Close string, Volume string")
    tagged = df.withColumn("_source_file", F.monotonically_increasing_id())
    row = quality.quality_score(quality.overall(tagged)).first()
    assert (row["total_rows"], row["total_null"], row["rows_with_null"], row["duplicate_rows"]) == (6, 7, 3, 2)
    assert row["rows_with_null_pct"] == 50.0 and row["quality_score"] == 50.0
    assert dedup.duplicate_count(tagged).first()[0] == 2
    assert dedup.duplicate_count(tagged, exclude=()).first()[0] == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "Date string, Close double")
    assert quality.overall(df).first()["rows_with_null_pct"] == 0.0
    assert {r["null_pct"] for r in quality.profile(df).collect()} == {0.0}


def test_newest_file_wins(spark):
    day = datetime.date(2024, 1, 1)
    rows = [("A", day, 1.0, 10), ("A", day, 2.0, 30), ("A", day, 3.0, 20), ("B", day, 4.0, 10)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, Close double, _source_modified long")
    kept = {r["Ticker"]: r["Close"] for r in dedup.dedup_newest(df).collect()}
    assert kept == {"A": 2.0, "B": 4.0}


def test_audit_round_trip(spark, tmp_path):
    path = str(tmp_path / "audit")
    quality.audit(spark, path, "check", "completed", "me", {"rows": 5})
    quality.audit(spark, path, "check", "failed", "me")
    rows = quality.read_audit(spark, path).collect()
    assert [r["status"] for r in rows] == ["failed", "completed"]
    assert rows[1]["details"] == {"rows": "5"}
