"""Operators of a training-data pipeline: scans, search, cleaning, deduplication, tokenization."""
