"""Incremental feature production with Structured Streaming."""
