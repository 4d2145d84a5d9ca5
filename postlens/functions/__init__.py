"""Column functions: native Spark expressions, no Python workers."""
