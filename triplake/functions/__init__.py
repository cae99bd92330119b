"""Column expressions shared by the operators. No Python functions run per row."""
