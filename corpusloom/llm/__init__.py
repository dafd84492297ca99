"""Operators for training-data pipelines: dedup, tokens, quality, privacy, mixing, packing."""
