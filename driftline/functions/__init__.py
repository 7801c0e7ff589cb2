"""Column expressions: everything here builds native Spark expressions only."""
