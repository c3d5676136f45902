"""Operators of a training-data pipeline: deduplication, tokens, languages, quality, scoring and shards."""
