"""Checkpointed incremental runs."""
