"""Incremental (Structured Streaming) ingestion of run documents."""
