"""Incremental staging with Structured Streaming."""
