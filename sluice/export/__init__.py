"""Exports: nested JSON, Parquet, CSV, the schema dictionary and the manifest."""
