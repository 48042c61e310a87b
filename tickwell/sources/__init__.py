"""Readers: vendor files, tables and the catalog."""
