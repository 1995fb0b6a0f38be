"""Column-to-column functions built from Spark SQL built-ins only."""
