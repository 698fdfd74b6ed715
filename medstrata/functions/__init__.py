"""Column expressions shared by the operators; all of them native to Spark."""
