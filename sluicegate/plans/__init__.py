"""Whole runs: gated ingest, promotion between layers, clean-up."""
