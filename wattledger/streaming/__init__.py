"""Incremental file loads with Structured Streaming."""
