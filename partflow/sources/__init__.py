"""Reads: inventories, partitioned parquet, snapshots, landed documents."""
