"""Column functions: plain expressions over Spark built-ins."""
