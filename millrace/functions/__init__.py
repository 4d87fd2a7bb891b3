"""Column expressions: names, types, time keys, error classes."""
