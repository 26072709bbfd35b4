"""Incremental discovery of new partitions."""
