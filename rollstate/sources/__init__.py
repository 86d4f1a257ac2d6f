"""Fact store, JSON codec, Kafka and JDBC adapters."""
