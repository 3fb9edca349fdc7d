"""Queries over the driver's tables, and whole pipelines."""
