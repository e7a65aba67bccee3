"""Structured Streaming: file stream -> foreachBatch(prepare + merge), many tables, metrics."""

from tidemark.streaming.stream import StreamMetrics, change_stream, stream_table, stream_tables

__all__ = ["StreamMetrics", "change_stream", "stream_table", "stream_tables"]
