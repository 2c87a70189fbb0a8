"""Structured Streaming jobs (live match state)."""
