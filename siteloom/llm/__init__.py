"""Operators for training-data pipelines: fingerprints, archives, packing, tokens, quality,
exact search, language models, near and exact duplicates."""
