"""Incremental refresh of the raw layer."""
