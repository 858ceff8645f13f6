"""Incremental ingest of file drops with Structured Streaming."""
