"""Queries over groups of documents: shared passages, near copies, fuzzy lines, benchmark leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import contamination, jaccard, lines, substrings
from candlewick.llm.registry import query, table

_SUBSTRINGS_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS (
    SELECT row_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS words
    FROM (SELECT row_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
), dropped AS (
    SELECT DISTINCT row_id, unnest(range(i, i + 35)) AS place
    FROM (SELECT row_id, i, count(*) OVER (PARTITION BY words) AS n FROM windows) WHERE n > 1
), each AS (
    SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs
), kept AS (
    SELECT row_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS words
    FROM each ANTI JOIN dropped USING (row_id, place) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)
"""


@query("op4_substring_dedup", _SUBSTRINGS_SQL)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    parsed = substrings.remove_duplicates(table(spark, folder, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

@query("op10_fuzzy_lines")
def fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = lines.remove_duplicate_lines(docs)
    return cleaned.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)) + F.col("n_removed_lines")).cast("long").alias("n_lines"),
        "n_removed_lines",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op9_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination.leaks(docs, table(spark, folder, "benchmark"))
    lists = found.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("n_words").alias("n_words")
    )
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return marked.join(lists, same, "left").select(
        "doc_id",
        F.col("_id").isNotNull().alias("leaked"),
        F.coalesce("item_ids", F.expr("cast(array() as array<bigint>)")).alias("item_ids"),
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
    )


_JACCARD_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b USING (gram) JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
    WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(sa.n) + any_value(sb.n) - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT docs.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
"""


@query("op3_ngram_jaccard", _JACCARD_SQL)
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = jaccard.similar_groups(docs, n=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
