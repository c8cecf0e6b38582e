"""Incremental intake of newly landed trip files with Structured Streaming."""

from tripaudit.streaming.intake import flagged_stream, read_history, read_intake, record_history, start_intake

__all__ = ["flagged_stream", "read_history", "read_intake", "record_history", "start_intake"]
