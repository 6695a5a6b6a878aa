"""Column expressions and plan-time checks."""
