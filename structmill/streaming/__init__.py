"""Incremental processing of streams."""
