"""Column expressions (no Python workers involved)."""
