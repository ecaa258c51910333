"""Incremental ingestion with Structured Streaming."""

from lakeloom.streaming.bronze_stream import bronze_stream

__all__ = ["bronze_stream"]
