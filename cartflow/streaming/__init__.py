"""Structured Streaming: replay, sources, running aggregates and sinks."""
