"""Structured Streaming jobs: ingest, live counts and live scoring."""
