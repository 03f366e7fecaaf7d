"""Incremental ingestion with Structured Streaming checkpoints."""
