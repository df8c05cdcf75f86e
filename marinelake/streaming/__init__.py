"""Structured Streaming jobs over the same column expressions."""
