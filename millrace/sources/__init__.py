"""Readers and table layout."""
