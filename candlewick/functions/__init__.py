"""Column expressions: scalar, masking and window building blocks."""
