"""Column functions: Columns in, Column out."""
