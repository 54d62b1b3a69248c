"""Column expressions. All are built-in functions, so they stay inside generated code."""
