"""Column expressions; all of them built from Spark's own functions."""
