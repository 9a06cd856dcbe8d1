"""Operators for training text: tokens, near duplicates, extraction, personal data, quality, contamination.

Nothing else in the library imports this package. ``candlewick.llm.queries`` registers its queries.
"""
