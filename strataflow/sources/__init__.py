"""File landing, Parquet tables and the review-aspect cache file."""
