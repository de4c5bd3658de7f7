"""Structured Streaming: raw event ingest and the keyed insert-only upsert."""
