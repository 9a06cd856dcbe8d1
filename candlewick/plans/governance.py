"""Data quality and masking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions import masking
from candlewick.operators import privacy, quality
from candlewick.plans import fixtures as fx
from candlewick.plans.fixtures import with_tables
from candlewick.plans.registry import query, rounded
from candlewick.schemas import AUDIT
from candlewick.session import scratch_path
from candlewick.sources.files import read_docs
from candlewick.sources.sinks import append_docs

COLUMNS = ("Date", "Ticker", "Open", "High", "Low", "Close", "Volume")
NUMBERS = {"Open": "double", "High": "double", "Low": "double", "Close": "double", "Volume": "bigint"}
MUST_BE_NUMERIC = ("Open", "High", "Low", "Close", "Volume")
ROW = ", ".join(f'"{c}"' for c in COLUMNS)


def _profile_sql(source: str, typed: bool) -> str:
    parts = []
    for c in COLUMNS:
        q = f'"{c}"'
        number = typed and c in NUMBERS
        dtype = (NUMBERS.get(c) or {"Date": "date"}.get(c, "string")) if typed else "string"
        stats = (
            f"round(CAST(min({q}) AS DOUBLE), 4), round(CAST(max({q}) AS DOUBLE), 4), round(avg({q}), 4), "
            f"round(stddev_samp({q}), 4)" if number else ", ".join(["CAST(NULL AS DOUBLE)"] * 4)
        )
        bad = f"count(*) FILTER ({q} IS NOT NULL AND TRY_CAST({q} AS DOUBLE) IS NULL)"
        errors = f"{bad}, round({bad} * 100.0 / greatest(count(*), 1), 2)" if c in MUST_BE_NUMERIC else "NULL, NULL"
        days = f"count(*) FILTER ({q} IS NOT NULL AND TRY_CAST({q} AS DATE) IS NULL)" if c == "Date" else "NULL"
        parts.append(
            f"SELECT '{c}', '{dtype}', count({q}), count(*) - count({q}), "
            f"round((count(*) - count({q})) * 100.0 / greatest(count(*), 1), 2), count(DISTINCT {q}), "
            f"{stats}, {errors}, {days} FROM {source}"
        )
    names = (
        '"column", dtype, total, null_count, null_pct, unique_count, "min", "max", "mean", "std", '
        "type_errors, type_error_pct, date_parse_errors"
    )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS t({names})"


@query("dq_profile", with_tables("gappy", body=_profile_sql("gappy", True)))
def dq_profile(spark, sf):
    return rounded(quality.profile(fx.gappy(spark, sf).select(*COLUMNS)), 4)


@query("dq_profile_raw", with_tables("dirty", body=_profile_sql("dirty", False)))
def dq_profile_raw(spark, sf):
    return rounded(quality.profile(fx.dirty(spark, sf)), 4)


@query("dq_profile_approx", with_tables("bars_many", body=" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count("{c}") AS total, CAST(count(*) FILTER ("{c}" IS NULL) AS BIGINT) AS null_count,
           TRUE AS sketch_fits, TRUE AS profile_fits FROM bars_many""" for c in COLUMNS)))
def dq_profile_approx(spark, sf):
    """Sketches of three runs, stored and merged, and those of one profile: both within three deviations (1.6 and
    5 percent) of the exact number of distinct values."""
    bars, path = fx.bars_many(spark, sf), scratch_path(spark, "sketches")
    for run in range(3):
        part = bars.filter(F.pmod(F.hash("Ticker"), F.lit(3)) == run)
        quality.column_sketches(part, str(run)).write.mode("append").partitionBy("run").parquet(path)
    merged = quality.merged_profile(spark.read.schema(quality.SKETCH).parquet(path))
    exact = quality.profile(bars).select("column", F.col("unique_count").alias("exact"))
    estimated = quality.profile(bars, exact=False).select("column", F.col("unique_count").alias("estimate"))
    near = lambda c, share: F.abs(F.col(c) - F.col("exact")) <= F.greatest(F.lit(1), share * F.col("exact"))
    return merged.join(exact, "column").join(estimated, "column").select(
        "column", "total", "null_count", near("unique_estimate", 0.05).alias("sketch_fits"),
        near("estimate", 0.15).alias("profile_fits"),
    )


@query("dq_numeric_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(CAST(min({c}) AS DOUBLE), 4) + 0.0 AS \"min\", "
    f"round(CAST(max({c}) AS DOUBLE), 4) AS \"max\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std "
    "FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")))
def dq_numeric_stats(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    wanted = items.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    return rounded(quality.numeric_stats(wanted), 4)


@query("dq_type_errors", with_tables("dirty", body=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" IS NOT NULL AND TRY_CAST(\"{c}\" AS DOUBLE) IS NULL) "
    f"AS type_errors, round(count(*) FILTER (\"{c}\" IS NOT NULL AND TRY_CAST(\"{c}\" AS DOUBLE) IS NULL) "
    "* 100.0 / greatest(count(*), 1), 2) AS type_error_pct FROM dirty" for c in MUST_BE_NUMERIC)))
def dq_type_errors(spark, sf):
    return quality.type_errors(fx.dirty(spark, sf))


@query("dq_date_errors", with_tables("dirty", body="""
    SELECT count(*) FILTER ("Date" IS NOT NULL AND TRY_CAST("Date" AS DATE) IS NULL) AS date_parse_errors
    FROM dirty"""))
def dq_date_errors(spark, sf):
    return quality.date_errors(fx.dirty(spark, sf))


_OVERALL = f"""
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n * nulls) AS BIGINT) AS total_null,
           CAST(coalesce(sum(n) FILTER (nulls > 0), 0) AS BIGINT) AS rows_with_null,
           CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
           round(coalesce(sum(n) FILTER (nulls > 0), 0) * 100.0 / greatest(sum(n), 1), 2) AS rows_with_null_pct
    FROM (SELECT count(*) AS n, {" + ".join(f'CAST("{c}" IS NULL AS INTEGER)' for c in COLUMNS)} AS nulls
          FROM dirty GROUP BY {ROW})"""


@query("dq_overall", with_tables("dirty", body=_OVERALL))
def dq_overall(spark, sf):
    return quality.overall(fx.dirty(spark, sf))


@query("dq_score", with_tables("dirty", body=f"SELECT *, 100 - rows_with_null_pct AS quality_score FROM ({_OVERALL})"))
def dq_score(spark, sf):
    return quality.quality_score(quality.overall(fx.dirty(spark, sf)))


def _light_sql() -> str:
    any_null = " OR ".join(f'"{c}" IS NULL' for c in COLUMNS)
    parts = [
        "SELECT 'total_rows', NULL, CAST(count(*) AS VARCHAR) FROM dirty",
        f"SELECT 'null_rows', NULL, CAST(count(*) FILTER ({any_null}) AS VARCHAR) FROM dirty",
        f"SELECT 'null_pct', NULL, CAST(round(CAST(count(*) FILTER ({any_null}) AS DOUBLE) * 100 / count(*), 2) "
        "AS VARCHAR) FROM dirty",
        """SELECT 'date_range', NULL, min("Date") || ' to ' || max("Date") FROM dirty""",
        """SELECT 'tickers', "Ticker", CAST(count(*) AS VARCHAR) FROM dirty GROUP BY "Ticker" """,
    ]
    parts += [
        f"SELECT 'null_counts', '{c}', CAST(count(*) FILTER (\"{c}\" IS NULL) AS VARCHAR) FROM dirty" for c in COLUMNS
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS t(section, item, value)"


@query("dq_light", with_tables("dirty", body=_light_sql()))
def dq_light(spark, sf):
    return quality.light_report(fx.dirty(spark, sf))


@query("audit_log", with_tables("logs", body="""
    SELECT "@timestamp" AS "timestamp", 'check' AS action,
           CASE WHEN severity = 'FATAL' THEN 'failed' ELSE 'completed' END AS status, pipeline AS "user",
           CAST(duration_ms AS VARCHAR) AS rows_checked FROM logs"""))
def audit_log(spark, sf):
    """Every run leaves an audit document; the documents are read back, newest first."""
    entries = fx.logs(spark, sf).select(
        F.col("@timestamp").cast("timestamp").alias("timestamp"),
        F.lit("check").alias("action"),
        F.when(F.col("severity") == "FATAL", "failed").otherwise("completed").alias("status"),
        F.col("pipeline").alias("user"),
        F.create_map(F.lit("rows_checked"), F.col("duration_ms").cast("string")).alias("details"),
    )
    path = scratch_path(spark, "audit")
    append_docs(entries, path)
    stored = read_docs(spark, path, AUDIT, multi_line=False).orderBy(F.col("timestamp").desc())
    return stored.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "action", "status", "user",
        F.col("details")["rows_checked"].alias("rows_checked"),
    )


@query("report_flatten", with_tables("gappy", body=f"""
    SELECT 'bars' AS dataset, "column", dtype, total, null_count, null_pct, unique_count
    FROM ({_profile_sql("gappy", True)})"""))
def report_flatten(spark, sf):
    bars = fx.gappy(spark, sf).select(*COLUMNS)
    report = quality.nested_report(quality.profile(bars), quality.overall(bars), "bars")
    return quality.flatten_report(report).select(
        "dataset", "column", "dtype", "total", "null_count", "null_pct", "unique_count"
    )


_LOCAL = "split_part(email, '@', 1)"
_EMAIL = (
    f"left({_LOCAL}, 1) || '****' || CASE WHEN length({_LOCAL}) > 2 THEN right({_LOCAL}, 1) ELSE '' END "
    "|| '@' || split_part(email, '@', 2)"
)
_WORDS = r"regexp_split_to_array(trim(nama_lengkap), '\s+')"
_NAME = (
    f"CASE WHEN len({_WORDS}) > 1 THEN {_WORDS}[1] || ' ' || left({_WORDS}[-1], 1) || '***' ELSE nama_lengkap END"
)
_PHONE = "left(no_telepon, 3) || '****' || right(no_telepon, 3)"
_STREET = r"regexp_split_to_array(trim(split_part(alamat, ',', 1)), '\s+')"
_ADDRESS = f"{_STREET}[1] || ' ***** ' || {_STREET}[-1] || ', ' || substr(alamat, strpos(alamat, ',') + 1)"
_AMOUNT = (
    "CASE WHEN saldo_investasi >= 5000 THEN '> 100 juta' WHEN saldo_investasi >= 2500 THEN '50-100 juta' "
    "ELSE '< 50 juta' END"
)
# The test balances are small, so the thresholds are too; the labels are the standard ones.
BANDS = ((5000, "> 100 juta"), (2500, "50-100 juta"))


@query("mask_email", with_tables("traders", body=f"SELECT user_id, {_EMAIL} AS email, TRUE AS valid FROM traders"))
def mask_email(spark, sf):
    return fx.traders(spark, sf).select(
        "user_id", masking.mask_email("email").alias("email"), masking.valid_email("email").alias("valid")
    )


@query("mask_name", with_tables("traders", body=f"SELECT user_id, {_NAME} AS nama_lengkap FROM traders"))
def mask_name(spark, sf):
    return fx.traders(spark, sf).select("user_id", masking.mask_name("nama_lengkap").alias("nama_lengkap"))


@query("mask_phone", with_tables("traders", body=f"SELECT user_id, {_PHONE} AS no_telepon FROM traders"))
def mask_phone(spark, sf):
    return fx.traders(spark, sf).select("user_id", masking.mask_phone("no_telepon").alias("no_telepon"))


@query("mask_address", with_tables("traders", body=f"SELECT user_id, {_ADDRESS} AS alamat FROM traders"))
def mask_address(spark, sf):
    return fx.traders(spark, sf).select("user_id", masking.mask_address("alamat").alias("alamat"))


@query("generalize_amount", with_tables("traders", body=f"SELECT user_id, {_AMOUNT} AS kategori FROM traders"))
def generalize_amount(spark, sf):
    band = masking.generalize("saldo_investasi", BANDS, "< 50 juta")
    return fx.traders(spark, sf).select("user_id", band.alias("kategori"))


@query("mask_table", with_tables("traders", body=f"""
    SELECT user_id, {_NAME} AS nama_lengkap, {_EMAIL} AS email, {_PHONE} AS no_telepon, {_ADDRESS} AS alamat,
           {_AMOUNT} AS saldo_investasi_kategori, risk_profile FROM traders"""))
def mask_table(spark, sf):
    policy = {**privacy.TRADER_POLICY, "saldo_investasi": privacy.banded("saldo_investasi_kategori", BANDS)}
    return privacy.mask_table(fx.traders(spark, sf), policy)


@query("hash_pii", with_tables("traders", body="""
    SELECT user_id, sha256('pepper' || email) AS email, sha256('pepper' || no_telepon) AS no_telepon FROM traders"""))
def hash_pii(spark, sf):
    rule = privacy.hashed("pepper")
    people = fx.traders(spark, sf).select("user_id", "email", "no_telepon")
    return privacy.mask_table(people, {"email": rule, "no_telepon": rule})


_RECORDED = (
    ("email", "partial mask", "email", _EMAIL), ("nama_lengkap", "partial mask", "nama_lengkap", _NAME),
    ("no_telepon", "partial mask", "no_telepon", _PHONE), ("alamat", "generalized", "alamat", _ADDRESS),
    ("saldo_investasi", "bands", "saldo_investasi_kategori", _AMOUNT),
)


@query("masking_record", with_tables("traders", body=" UNION ALL ".join(f"""
    SELECT 'people' AS original_file, CAST(count(*) AS BIGINT) AS n_rows, '{name}' AS field, '{method}' AS method,
           '{stored}' AS stored_as, CAST(count({name}) AS BIGINT) AS n_values,
           CAST(count(*) FILTER (CAST({name} AS VARCHAR) <> ({sql})) AS BIGINT) AS n_changed FROM traders"""
    for name, method, stored, sql in _RECORDED)))
def masking_record(spark, sf):
    """What a masking run did, stored as a document and read back, one row per field."""
    policy = {**privacy.TRADER_POLICY, "saldo_investasi": privacy.banded("saldo_investasi_kategori", BANDS)}
    path = scratch_path(spark, "record")
    append_docs(privacy.masking_record(fx.traders(spark, sf), policy, "people", "masked"), path)
    layout = (
        "original_file string, masked_file string, n_rows long, "
        "fields_masked array<struct<field:string,method:string,stored_as:string,n_values:long,n_changed:long>>"
    )
    docs = read_docs(spark, path, layout, multi_line=False)
    return docs.select("original_file", "n_rows", F.inline("fields_masked"))
