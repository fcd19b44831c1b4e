"""Structured Streaming ingest (file source, availableNow, checkpointed)."""
