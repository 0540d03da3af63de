"""Incremental runs of the batch marts with Structured Streaming."""
