"""Structured Streaming forms of the ingest and stateful operators."""
