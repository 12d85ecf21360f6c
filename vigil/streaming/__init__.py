"""Incremental jobs with Structured Streaming (file sources, checkpoints)."""
