"""Column expressions computed from one row."""
