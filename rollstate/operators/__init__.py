"""Aggregate registry, rollups and dimension operators."""
