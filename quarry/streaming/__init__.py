"""Structured Streaming jobs over live events."""
