"""Incremental (Structured Streaming) form of the per-row cleaning stages."""

from catalogprep.streaming.incremental import clean_titles_incremental, read_titles_stream, start_clean_stream

__all__ = ["clean_titles_incremental", "read_titles_stream", "start_clean_stream"]
