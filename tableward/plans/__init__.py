"""Whole flows built from the operators: ingest normalisation and cleaning."""
