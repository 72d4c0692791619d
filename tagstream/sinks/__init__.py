"""Replay-safe targets: Parquet stores, key-value servers, SQL tables, Kafka topics."""
