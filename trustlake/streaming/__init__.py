"""Structured Streaming forms of the log's incremental parts."""
