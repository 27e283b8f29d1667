"""Contracts, CSV scans, dated Parquet tables and small sinks."""
