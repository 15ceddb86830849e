"""Column functions: pure expressions."""
