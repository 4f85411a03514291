"""Column expressions: every scalar rule as a native Spark expression."""
