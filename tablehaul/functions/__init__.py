"""Column expressions: type targets and value coercion."""
