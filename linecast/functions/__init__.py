"""Column expressions (JVM built-ins only, code-generated)."""
