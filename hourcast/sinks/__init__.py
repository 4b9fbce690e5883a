"""Sinks: CSV, table writes, keyed upserts on day-partitioned parquet tables."""
