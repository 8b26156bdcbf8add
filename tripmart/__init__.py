"""Layered trip analytics as Spark jobs: capture, quality, star schema, checks."""
