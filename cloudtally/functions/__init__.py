"""Column functions: Column in, Column out, all built-in expressions."""
