"""Partitioned Parquet writers and catalog registration."""
