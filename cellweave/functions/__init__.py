"""Column functions: everything that is a scalar of one row."""
