"""Versioned Parquet tables."""
