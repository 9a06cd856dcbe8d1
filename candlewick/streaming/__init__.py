"""Structured Streaming: ticks, windows, sinks, scoring."""
