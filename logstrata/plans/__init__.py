"""Whole jobs: the six datasets and the incremental ingest that publishes them."""
