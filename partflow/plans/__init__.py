"""Whole jobs: read, decide, write, record."""
