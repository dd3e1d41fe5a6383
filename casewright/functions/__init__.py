"""Column expressions built from Spark functions only."""
