"""Operators as DataFrame transformations."""
