"""Schemas, readers, writers and keyed upserts."""
