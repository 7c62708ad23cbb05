"""Structured Streaming ingestion, dead letters, retry."""
