"""Column functions: pixel algebra, geometry, text."""
