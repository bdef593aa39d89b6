"""Typed CSV / JSON / Parquet readers, optional inputs, writers, model artifacts."""
