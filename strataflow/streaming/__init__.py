"""Structured Streaming variants of landing, late parents and deduplication."""
