"""Operators for training-data pipelines: filtering, counting, scoring, deduplication and packing of texts."""
