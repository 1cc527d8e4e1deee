"""Readers and writers: Parquet, CSV, JSON, catalog tables, markdown and the run log."""
