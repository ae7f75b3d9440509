"""Scans and sinks: CSV landing, manifests, run-scoped parquet, partitioned tables, catalog."""
