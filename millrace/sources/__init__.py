"""Readers of landed files and the versioned Parquet tables the jobs write."""
