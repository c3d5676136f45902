"""Ingest driven by newly arriving files."""
