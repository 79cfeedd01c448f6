"""Structured Streaming twins of the stateful rules."""
