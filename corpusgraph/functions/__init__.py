"""Column expressions and scale helpers shared by the operators."""
