"""Incremental table extraction and change merging on Spark."""
