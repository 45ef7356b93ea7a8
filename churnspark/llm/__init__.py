"""Operators of a training-data pipeline: text clean-up, near-duplicates, tokens, packing."""
