"""Incremental ingestion by Structured Streaming."""
