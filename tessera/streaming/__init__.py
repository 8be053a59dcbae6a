"""Structured Streaming variants of the batch jobs."""

from .word_stream import document_stream, streaming_word_counts, start_word_counts

__all__ = ["document_stream", "streaming_word_counts", "start_word_counts"]
