"""Column functions: each takes and returns columns, none runs Python per row."""
