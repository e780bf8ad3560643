"""Structured Streaming variant of the client-log ingest."""
