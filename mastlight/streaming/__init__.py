"""Structured Streaming forms of the ingest and monitoring queries."""
