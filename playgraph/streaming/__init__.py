"""Structured Streaming jobs: incremental run-log summary, snapshot ingest."""
