"""Readers for exports, reference files and JSON snapshots."""
