"""Incremental loading of landing batches with Structured Streaming."""
