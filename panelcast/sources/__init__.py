"""Readers and writers (parquet, CSV, JSON lines, JSON reports, model packages)."""
