"""Composite plans: the registered queries and their SQL oracles."""
