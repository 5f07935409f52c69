"""Readers, writers and the binding of logical tables to Parquet folders."""
