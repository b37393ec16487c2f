"""Structured Streaming: a fitted detector over arriving records."""
