"""Column expressions and building blocks the operators share."""
