"""Readers, writers and the derived sample trip table."""
