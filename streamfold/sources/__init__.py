"""Readers: driver tables, Kafka-shaped records, change feeds, generators."""
