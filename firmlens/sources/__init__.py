"""Sources of the enrichment engine."""
