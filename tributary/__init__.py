"""Public-sector analytics on Spark: landing, reconciliation, history and quality checks."""
