"""Column functions: built-in expressions first, Arrow UDFs only where Spark has no equivalent."""
