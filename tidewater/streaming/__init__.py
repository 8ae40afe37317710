"""Structured Streaming entry points: raw ingest, registry, structured upsert,
database publish, and the stop helpers."""
