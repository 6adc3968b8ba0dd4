"""Column expressions, all built-in functions."""
