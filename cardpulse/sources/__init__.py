"""Readers and writers at the edge: transaction streams, the wire frame, static tables."""
