"""Column expressions of the range-split rule."""
