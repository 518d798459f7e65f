"""Column functions: everything that works inside one row."""
