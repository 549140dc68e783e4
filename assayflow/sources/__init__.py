"""Readers and writers: landed JSON, raw Parquet, merged tables."""
