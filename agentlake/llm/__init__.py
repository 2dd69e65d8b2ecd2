"""Operators for training-data pipelines: filters, near-duplicate search, mixing, token output."""
