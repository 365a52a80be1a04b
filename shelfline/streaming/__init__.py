"""Structured Streaming sources, windows and sinks."""
