"""Registers the queries of all operators."""

from candlewick.llm import queries_duplicates, queries_models, queries_rows, queries_tokens, queries_vectors  # noqa: F401
from candlewick.llm.registry import ORACLES, QUERIES  # noqa: F401
