"""Structured Streaming trigger for the incremental upsert."""

from .arrivals import upsert_stream

__all__ = ["upsert_stream"]
