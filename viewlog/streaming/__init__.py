"""Structured Streaming: incremental ingest of new log files."""
