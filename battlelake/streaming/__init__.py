"""Structured Streaming jobs, their sinks and the state kept between batches."""
