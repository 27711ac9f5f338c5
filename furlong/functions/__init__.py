"""Column expressions for parsing and arithmetic."""
