"""Column expressions shared by the operators (Spark built-ins only)."""
