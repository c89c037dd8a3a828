"""Structured Streaming: exactly-once keyed delta sink, stream jobs, rate feeds."""
