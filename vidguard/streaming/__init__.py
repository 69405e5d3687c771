"""Incremental form of the snapshot ingest."""
