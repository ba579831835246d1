"""Column functions: they take and return columns and stay inside generated code."""
