"""Structured Streaming: the feature queries and their sinks."""
