"""Structured Streaming form of the scoring step."""

from cohortlab.streaming.score import score_stream

__all__ = ["score_stream"]
