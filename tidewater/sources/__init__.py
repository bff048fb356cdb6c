"""Readers: parquet tables, Kafka-shaped records, derived fixtures."""
