"""Column expressions and aggregates shared by the operators."""
