"""Column expressions and vectorised batch functions."""
