"""Plans of the enrichment engine."""
