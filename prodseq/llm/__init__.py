"""Operators of a training-data pipeline: filters, near-duplicates, tokens, packing."""
