"""Queries that turn texts into token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import alignment, bpe, planes
from candlewick.llm.registry import query, table
from candlewick.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


@query("op1_bit_planes")
def bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-planes")
    planes.write_ids(table(spark, folder, "documents"), path, public_tokenizers.path(TOKENIZER))
    return planes.read_digests(spark, path).withColumnRenamed("id", "doc_id")


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coder = bpe.ByteBpe(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return coder.encode_and_decode(docs).select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    a, b = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.aligned(docs, a, public_tokenizers.PATTERN, b)
