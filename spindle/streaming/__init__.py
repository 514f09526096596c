"""Structured Streaming: apply fitted pipelines to streams."""

from spindle.streaming.scoring import score_stream, windowed_accuracy, write_scores  # noqa: F401
