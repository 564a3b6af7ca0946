"""Structural-annotation analytics as Spark jobs."""
