"""Structured Streaming jobs."""

from labeltext.streaming.score import read_text_stream, score_stream
from labeltext.streaming.versions import batch_ledger, score_stream_by_version, scored_batches

__all__ = ["batch_ledger", "read_text_stream", "score_stream", "score_stream_by_version", "scored_batches"]
