"""Column-level functions: everything here is built-in Spark SQL, so it stays inside generated code."""
