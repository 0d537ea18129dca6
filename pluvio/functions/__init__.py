"""Column functions: pure expressions, no data access."""
