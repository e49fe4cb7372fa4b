"""Incremental counts on Structured Streaming."""
