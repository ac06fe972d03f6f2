"""Schemas, readers, writers and key checks."""
