"""Structured Streaming forms of batch checks."""

from cairn.streaming.freshness import announce, arrived, read_arrivals, streamed_freshness, watch

__all__ = ["announce", "arrived", "read_arrivals", "streamed_freshness", "watch"]
