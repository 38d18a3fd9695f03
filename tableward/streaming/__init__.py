"""Incremental ingest and cleaning, as batch cycles and as streaming queries."""
