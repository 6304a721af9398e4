"""Company-enrichment analytics on PySpark."""
