"""Column functions: JSON bodies, event time, table numbers."""
