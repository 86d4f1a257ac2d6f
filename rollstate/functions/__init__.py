"""Time buckets, naming, geometry: column expressions."""
