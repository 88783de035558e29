"""Column expressions and distributed building blocks shared by the operators."""
