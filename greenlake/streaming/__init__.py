"""Structured Streaming jobs for weather feeds."""
