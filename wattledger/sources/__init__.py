"""Readers for landed payloads and files, and the matching sinks."""
