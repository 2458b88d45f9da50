"""Structured Streaming jobs and the progress listener."""
