"""Incremental ingest and streaming aggregation."""
