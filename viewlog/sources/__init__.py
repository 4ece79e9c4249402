"""Scans (text logs, Parquet tables, test-table views) and sinks (Parquet, tables, JDBC)."""
