"""Column-level cleaning rules."""
