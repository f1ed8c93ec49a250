"""amendry: set-based correction and reconciliation jobs on Spark tables."""
