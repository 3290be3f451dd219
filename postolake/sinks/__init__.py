"""Sinks: partitioned Parquet tables."""
