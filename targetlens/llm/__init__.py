"""Operators of a training-data pipeline: deduplication, filtering, tokens, extraction."""
