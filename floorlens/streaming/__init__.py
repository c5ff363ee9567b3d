"""Structured Streaming forms of ingest and mart refresh."""
