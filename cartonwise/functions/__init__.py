"""Column functions: each takes columns and returns a column; all stay inside generated JVM code."""
