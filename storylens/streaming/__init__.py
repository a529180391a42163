"""Structured Streaming form of the daily attribution (incremental over new captures)."""

from storylens.streaming.incremental import attribution_stream, start_attribution_stream  # noqa: F401
