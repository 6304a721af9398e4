"""Streaming of the enrichment engine."""
