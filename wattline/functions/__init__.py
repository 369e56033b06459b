"""Column expressions and row-sequence building blocks."""
