"""Column expressions and small vectorised functions."""
