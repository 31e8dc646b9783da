"""Scans and sinks: raw CSV, Parquet tables, JSON documents, feature lists, models, wire lines."""
