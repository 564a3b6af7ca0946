"""Stages, their order, and the registered queries."""
