"""Column helpers; all built from Spark SQL expressions."""
