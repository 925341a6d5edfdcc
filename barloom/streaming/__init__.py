"""Continuous ingestion and incremental publishing."""
