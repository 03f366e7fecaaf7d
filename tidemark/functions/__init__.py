"""Column expressions: no Python runs per row."""
