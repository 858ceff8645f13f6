"""Column expressions: everything here maps columns to columns and runs inside generated code."""
