"""Structured Streaming forms of the progress and rate queries."""
