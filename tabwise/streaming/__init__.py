"""Structured Streaming variants of the load path."""

from tabwise.streaming.incremental import stream_append_load  # noqa: F401
