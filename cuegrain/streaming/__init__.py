"""Structured Streaming forms of the feeds."""
