"""Operators for training-data pipelines: filters, deduplication, contamination, secrets, language, quality, mixing."""
