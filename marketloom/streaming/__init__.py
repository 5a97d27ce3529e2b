"""Incremental ingestion of landed payload files."""
