"""Queries that judge each row by itself: extraction, personal data, chats, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import chat, html, pii, quality
from candlewick.llm.registry import query, table

_BASE_NAMES = "'email', 'ip', 'card', 'phone'"


@query("op5_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    extracted = pages.select("page_id", "url", html.extract(F.col("html")).alias("text"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))


@query("op6_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("personal", lambda x: x["kind"].isin(pii.base_kinds()))
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("personal", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.base_kinds()],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("personal")).alias("spans"),
    )


_ESCAPED = r"regexp_replace({x}, '<(\\*)(/?turn)', '<\\\1\2', 'g')"

_CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<turn><turn/></turn>') + 1 + length(ESCAPED_ROLE) + length(ESCAPED_TEXT)) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""".replace("ESCAPED_ROLE", _ESCAPED.format(x="role")).replace("ESCAPED_TEXT", _ESCAPED.format(x="text"))


@query("op7_chat_format", _CHAT_SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    done = chat.format_records(chat.records_of_turns(rows.unionByName(extra)))
    back = done.select(
        "conversation", "formatted",
        chat.read_turns(F.col("formatted")).alias("back"),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("loss")), "").alias("under_mask"),
    )
    told = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conversation").alias("conv_id"),
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("under_mask").cast("long").alias("loss_chars"),
        F.sha2("under_mask", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_QUALITY_SQL = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT row_id, i, array_to_string(w[i:i + 4], ' ') AS gram
    FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)
), repeats AS (
    SELECT row_id, count(DISTINCT place) AS n FROM (
        SELECT row_id, unnest(range(i, i + 5)) AS place
        FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS c FROM grams) WHERE c > 1
    ) GROUP BY row_id
), lines AS (
    SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
        CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS BIGINT) AS n_echo_words,
        CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaims,
        CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
        CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
    FROM docs LEFT JOIN repeats USING (row_id) LEFT JOIN lines USING (row_id)
), judged AS (
    SELECT *, RULE_BITS AS failed_rules FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept, failed_rules
FROM judged
""".replace(
    "RULE_BITS",
    "CAST(" + " + ".join(f"CASE WHEN {rule.fails} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(quality.RULES)) + " AS BIGINT)",
)


@query("op8_quality_rules", _QUALITY_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.with_ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *[F.col(f"ledger.{name}").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality.passes("base", F.col("ledger.failed"))).alias("base_failed"),
        quality.passes("v1", F.col("ledger.failed")).alias("kept"),
        F.col("ledger.failed").alias("failed_rules"),
    )
