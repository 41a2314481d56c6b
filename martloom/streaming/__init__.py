"""Incremental loads on Structured Streaming."""
