"""Incremental loads driven by Structured Streaming."""
