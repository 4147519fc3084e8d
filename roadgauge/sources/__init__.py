"""Readers: partitioned files, wrapped JSON records, incremental ranges, catalog tables."""
