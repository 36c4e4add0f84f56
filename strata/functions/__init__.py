"""Column-level rules shared by the jobs (built-in Spark functions only)."""
