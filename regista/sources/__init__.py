"""Readers and writers for landing, catalog, staging, mart and serving tables."""
