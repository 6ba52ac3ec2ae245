"""Operators for training-data pipelines: deduplication, filtering, tokenising, extraction, search and scoring."""
