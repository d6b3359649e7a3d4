"""Column functions built from Spark's own; no Python runs per row."""
