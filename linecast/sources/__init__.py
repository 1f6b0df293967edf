"""Sources: parquet tables, NDJSON lines, JDBC tables and trigger streams."""
