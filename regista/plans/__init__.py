"""Composed jobs: staging, marts, serving tables, indicators and maps."""
