"""Schemas, readers, writers and the adapter for the order and event tables."""
