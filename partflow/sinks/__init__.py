"""Writes: published partitions, snapshots, the ledger, manifests."""
