"""Incremental landing where Structured Streaming keeps the progress."""
