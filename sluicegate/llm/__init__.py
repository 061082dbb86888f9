"""Operators of a training-data pipeline: deduplication, filters, extraction, tokens, packing, search."""
