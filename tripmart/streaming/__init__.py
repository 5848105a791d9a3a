"""Incremental processing of newly arrived months."""
