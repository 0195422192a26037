"""Incremental silver tables from landing folders (Structured Streaming, availableNow)."""
