"""Incremental landing on Structured Streaming (same column expressions as batch)."""

from lakeq.streaming.landing import land_incrementally

__all__ = ["land_incrementally"]
