"""Column functions: everything here is row-local and built from Spark's own functions."""
