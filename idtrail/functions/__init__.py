"""Column functions and fixed vocabulary."""
