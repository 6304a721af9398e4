"""Functions of the enrichment engine."""
