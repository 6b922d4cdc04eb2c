"""Structured Streaming queries over the event stream."""
