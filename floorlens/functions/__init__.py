"""Column expressions and fixed values shared by all operators."""
