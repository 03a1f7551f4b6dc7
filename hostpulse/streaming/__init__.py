"""Structured Streaming jobs over the live operators."""
