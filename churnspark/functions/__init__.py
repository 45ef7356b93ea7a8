"""Column expressions and fixed lookup texts."""
