"""Queries that learn a model from the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bilinear
from candlewick.llm.registry import query, table


@query("op11_bilinear_scores")
def bilinear_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bilinear.scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
