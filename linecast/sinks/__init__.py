"""Sinks: idempotent appends to a predictions table (files or JDBC)."""
