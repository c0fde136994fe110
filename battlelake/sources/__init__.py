"""Readers: topics, JSON, CSV, parquet, dimensions and log lines."""
