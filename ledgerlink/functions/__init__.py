"""Column functions: text, tolerant casts, numbers.  All are built-in expressions."""
