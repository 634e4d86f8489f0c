"""Operators for training-data pipelines: quality, language, deduplication,
mixing, tokens, archives. Nothing else in the library imports this package."""
