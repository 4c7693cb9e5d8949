"""Readers of landed files, published snapshots and tables."""
