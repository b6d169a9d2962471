"""Column functions and the schema contract."""
