"""Structured Streaming: incremental ingest."""
