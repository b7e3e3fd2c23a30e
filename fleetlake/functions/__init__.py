"""Column rules: each takes columns and returns a column."""
