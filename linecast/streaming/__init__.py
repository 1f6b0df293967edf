"""Trigger-driven runs with Structured Streaming."""
