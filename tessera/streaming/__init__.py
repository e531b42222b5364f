"""Structured Streaming entry points (incremental indexing)."""
