"""Lakehouse operators for Spark: land, conform, deduplicate, aggregate, publish, reconcile."""
