"""Operators of the enrichment engine."""
