"""Structured Streaming ingest: validated bronze, quarantine, cold archive."""
