"""Structured Streaming re-aims: once-only file ingest (X1) and streaming minute aggregation."""
