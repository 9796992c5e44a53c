"""Structured Streaming versions of the ingest route and the keyed upsert."""
