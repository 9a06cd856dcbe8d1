"""Log normalisation, run and alert queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column, classify, first_non_empty, parse_timestamp, truncate
from candlewick.operators.series import Series, in_blocks

MESSAGE_LENGTH = 500
CHAT_LENGTH = 200

# Pipeline by part of the log path, first match wins.
PATH_RULES = (("batch", "batch"), ("stream", "stream"), ("ml", "ml"))


#: Fields of the common layout; what a document has besides them is in ``fields``.
COMMON = ("@timestamp", "severity", "pipeline", "message", "source_file")


def _json_string(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _as_json(value: Column, content: Column) -> Column:
    """JSON text of a field that was read as text: numbers, literals, lists and objects stay what they
    were unless the document has the same text in quotes."""
    quoted = F.contains(content, F.concat(F.lit('"'), value, F.lit('"')))
    return F.when(F.try_parse_json(value).isNotNull() & ~quoted, value).otherwise(_json_string(value))


def _last_values(fields: Column) -> Column:
    """A map without repeated keys: the last value of each counts."""
    keys, entries = F.map_keys(fields), F.map_entries(fields)
    last = lambda e, i: i == F.size(keys) - F.array_position(F.reverse(keys), e["key"])
    return F.map_from_entries(F.filter(entries, last))


def normalize_docs(docs: DataFrame, now: Column | None = None) -> DataFrame:
    """Documents (content, source_file, modified) to the common log layout, without losing a field.

    A JSON object gives its own fields, with fallbacks; other valid JSON is not a log and is left
    out; anything else, also an object with text behind it, becomes an INFO entry with the start of
    its text. ``now`` stamps objects without a time (default: the time the document was changed).

    ``fields`` maps the name of every other field that is not null to its JSON text, whatever its
    type. ``reject`` is null for a clean object, 'duplicate_key' for an object that repeats a key (the
    last value of a top-level key counts; a nested object that repeats one is kept as text), and
    'not_json' for text.
    """
    # Inside a list, text behind the document shows: the list cannot be read, or has two entries.
    listed = F.concat(F.lit("["), F.col("content"), F.lit("]"))
    at = lambda path: F.try_variant_get("_doc", path, "variant")
    looks_object = F.startswith(F.ltrim(F.col("content")), F.lit("{"))
    rows = docs.withColumns({
        "_doc": F.try_parse_json(listed),
        "_texts": F.when(looks_object, F.from_json(listed, "array<map<string,string>>")),
        "_typed": F.when(looks_object, F.from_json("content", "map<string,variant>")),
    })
    valid = F.coalesce(F.col("_doc").isNotNull() & at("$[0]").isNotNull() & at("$[1]").isNull(), F.lit(False))
    keys = F.json_object_keys("content")
    repeats = F.col("_doc").isNull() & (F.size("_texts") == 1) & keys.isNotNull()
    first = F.when(F.coalesce(repeats, F.lit(False)), F.col("_texts")[0])
    kind = F.when(valid & looks_object, "object").when(valid, "other").when(first.isNotNull(), "repeats").otherwise("text")
    rows = rows.withColumns({"_kind": kind, "_text": _last_values(first)}).filter("_kind <> 'other'")

    def got(name: str, kind: str = "string") -> Column:
        path = f"$[0]['{name}']" if name.startswith("@") else f"$[0].{name}"
        text = F.col("_text")[name]
        return F.coalesce(F.when(F.col("_kind") == "object", F.try_variant_get("_doc", path, kind)), text.try_cast(kind))

    is_object = F.col("_kind") != "text"
    typed = F.transform_values(_last_values(F.col("_typed")), lambda _, v: F.to_json(v))
    present = F.map_filter("_text", lambda _, v: v.isNotNull())
    guessed = F.transform_values(present, lambda _, v: _as_json(v, F.col("content")))
    known = F.when(is_object, F.coalesce(typed, guessed))
    stamp = parse_timestamp(first_non_empty(got("timestamp"), got("@timestamp")))
    fallback = now if now is not None else F.col("modified")
    return rows.select(
        F.when(is_object, F.coalesce(stamp, fallback)).otherwise(F.col("modified")).alias("@timestamp"),
        F.when(is_object, first_non_empty(got("severity"), got("level"), default="INFO"))
        .otherwise(F.lit("INFO")).alias("severity"),
        F.when(is_object, first_non_empty(got("pipeline"), got("flow"), default="unknown"))
        .otherwise(F.lit("unknown")).alias("pipeline"),
        F.when(is_object, first_non_empty(got("message"), got("status"), default=F.col("content")))
        .otherwise(truncate("content", MESSAGE_LENGTH)).alias("message"),
        got("run_id").alias("run_id"),
        got("duration_ms", "bigint").alias("duration_ms"),
        got("error_code", "bigint").alias("error_code"),
        got("stack_trace").alias("stack_trace"),
        "source_file",
        F.map_filter(known, lambda k, v: ~k.isin(*COMMON) & (v != "null")).alias("fields"),
        F.when(F.col("_kind") == "repeats", "duplicate_key").when(F.col("_kind") == "text", "not_json").alias("reject"),
    )


def normalize_text_logs(docs: DataFrame) -> DataFrame:
    """Plain log files (content, source_file, modified): one entry each, pipeline from the path."""
    return docs.select(
        F.col("modified").alias("@timestamp"),
        F.lit("INFO").alias("severity"),
        classify("source_file", PATH_RULES, "unknown").alias("pipeline"),
        truncate("content", MESSAGE_LENGTH).alias("message"),
        "source_file",
    )


def fatal_errors(logs: DataFrame) -> DataFrame:
    wanted = [c for c in ("@timestamp", "pipeline", "message", "run_id", "error_code", "stack_trace")
              if c in logs.columns]
    return logs.filter(F.col("severity") == "FATAL").select(*wanted)


def freshness(
    runs: DataFrame,
    max_age_seconds: int = 86_400,
    now: Column | None = None,
    job: str = "pipeline",
    ts: str = "timestamp",
    success: str = "completed",
) -> DataFrame:
    """Jobs whose last success is older than ``max_age_seconds``, with its age."""
    clock = now if now is not None else F.current_timestamp()
    last = F.max(F.when(F.col("status") == success, F.col(ts)))
    age = F.unix_micros(clock.cast("timestamp")) - F.unix_micros(F.col("last_success").cast("timestamp"))
    out = runs.groupBy(job).agg(last.alias("last_success"))
    return out.withColumn("age_seconds", age / 1_000_000).filter(F.col("age_seconds") > max_age_seconds)


def stale_periods(
    runs: DataFrame,
    series: Series,
    max_age_seconds: int = 86_400,
    hold_seconds: int = 300,
    now: Column | None = None,
    success: str = "completed",
) -> DataFrame:
    """When each job's freshness alert fired: its last success was too old, and stayed so for ``hold_seconds``.

    One row per period: the last success before it, when the alert became pending and when it fired, and
    the success that ended it (null while it fires). ``now`` ends the time looked at.
    """
    clock = now if now is not None else F.current_timestamp()
    done = runs.filter(F.col("status") == success).select(*series.key, *series.order)

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("_next", F.lead(series.time).over(w))

    rows = in_blocks(done, series, compute, before=0, after=1)
    second = lambda n: F.make_dt_interval(secs=F.lit(n))
    pending = F.col(series.time) + second(max_age_seconds)
    firing = F.col(series.time) + second(max_age_seconds + hold_seconds)
    return rows.select(
        *series.key, F.col(series.time).alias("last_success"), pending.alias("pending_since"),
        firing.alias("firing_since"), F.col("_next").alias("resolved_at"),
    ).filter(F.coalesce("resolved_at", clock.cast("timestamp_ntz")) > F.col("firing_since"))


def run_summary(
    runs: DataFrame,
    by: str = "pipeline",
    ts: str = "timestamp",
    completed: str = "completed",
    failed: str = "failed",
) -> DataFrame:
    return runs.groupBy(by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == completed).alias("completed"),
        F.count_if(F.col("status") == failed).alias("failed"),
        F.max(ts).alias("last_run"),
    )


def failure_messages(
    runs: DataFrame, flow: str = "pipeline", error: str = "error", tag: str = "Alert", failed: str = "failed"
) -> DataFrame:
    """Mail subject and body, and a short chat text, for every failed run."""
    text = F.coalesce(F.col(error), F.lit("unknown"))
    name = F.coalesce(F.col(flow), F.lit("unknown"))
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    rows = runs.filter(F.col("status") == failed)
    return rows.select(
        flow,
        "timestamp",
        F.concat(F.lit(f"[{tag}] Pipeline Failed: "), name).alias("subject"),
        F.concat(
            F.lit("Flow: "), name, F.lit("\nError: "), truncate(text, MESSAGE_LENGTH), F.lit("\nTime: "), stamp
        ).alias("body"),
        F.concat(
            F.lit("Pipeline Alert\nFlow: "), name, F.lit("\nError: "), truncate(text, CHAT_LENGTH)
        ).alias("chat"),
    )


def scatter_points(
    df: DataFrame,
    columns: Sequence[str] = ("Ticker", "Nama_Saham", "Returns_1d", "Volatility_5d", "Cluster"),
) -> DataFrame:
    """Return against volatility per scored row."""
    return df.filter(F.col("Cluster").isNotNull()).select(*columns)


def duration_series(
    runs: DataFrame, grain: str = "hour", by: str = "pipeline", ts: str = "@timestamp", value: str = "duration_ms"
) -> DataFrame:
    """Mean, longest and number of runs per job and period."""
    return runs.groupBy(by, F.date_trunc(grain, as_column(ts)).cast("timestamp_ntz").alias("period")).agg(
        F.avg(value).alias("avg_ms"), F.max(value).alias("max_ms"), F.count(F.lit(1)).alias("runs")
    )


def slowest_runs(runs: DataFrame, n: int, value: str = "duration_ms", tie: Sequence[str] = ()) -> DataFrame:
    """The n longest runs."""
    return runs.orderBy(F.col(value).desc_nulls_last(), *tie).limit(n)
