"""Readers, writers and versioned Parquet tables."""
