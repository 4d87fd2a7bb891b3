"""Whole loads: one table, or a batch of tables."""
