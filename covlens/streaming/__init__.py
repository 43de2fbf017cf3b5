"""Incremental ingestion of arriving slice files with Structured Streaming."""
