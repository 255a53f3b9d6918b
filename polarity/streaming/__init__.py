"""Micro-batch scoring of a review stream (see ``scoring``)."""

from polarity.streaming.scoring import prepare_stream, score_stream

__all__ = ["prepare_stream", "score_stream"]
