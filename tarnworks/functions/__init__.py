"""Column-level helpers built from Spark expressions only."""
