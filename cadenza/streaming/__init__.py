"""Structured Streaming forms of the batch operators (the reference is batch only)."""

from cadenza.streaming.interactions import running_interactions, start_to_parquet

__all__ = ["running_interactions", "start_to_parquet"]
