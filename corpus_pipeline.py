"""From raw documents to token ids: quality, duplicate lines, near copies, benchmark leaks, encoding.

Each stage takes all that the stage before kept. Stages are written as Parquet to the shared folder and
read again, so a lost executor costs a stage's tasks, never the stages before it.

Every stage keeps rows with a null id and all columns, whatever their names; an empty table stays empty. Rows
that repeat id and text are one document: they are kept, changed or dropped together. Null and empty texts
fail the quality rules, so they go in the first stage; given to a later stage they stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, contamination, jaccard, lines, quality
from candlewick.llm.graph import _unused
from candlewick.llm.registry import reachable_by_workers, table
from candlewick.session import scratch_path

#: The newest policy of the ledger.
POLICY = "v1"

#: Words of a shingle and least similarity in percent of near copies.
SHINGLE_WORDS, LEAST_PERCENT = 5, 80

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go."""
    reachable_by_workers(spark)
    (ledger,) = _unused(docs.columns, "_ledger")
    return quality.apply_policy(quality.with_ledger(docs, ledger=ledger), POLICY, f"{ledger}.failed").drop(ledger)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fuzzy duplicate lines one stays; documents of nothing but removed lines go."""
    (removed,) = _unused(docs.columns, "_removed")
    cleaned = lines.remove_duplicate_lines(docs, count=removed)
    left = (F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    reachable_by_workers(spark)
    return jaccard.keep_one_of_each(docs, n=SHINGLE_WORDS, percent=LEAST_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    reachable_by_workers(spark)
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every text, proved by decoding them."""
    reachable_by_workers(spark)
    coder = bpe.ByteBpe(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = coder.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), decoded="decoded")
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", bpe.token_count(F.col("ids")).alias("n_tokens"), "ids", exact.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Fuzzy lines by SimHash and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
