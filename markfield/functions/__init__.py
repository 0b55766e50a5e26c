"""Column builders and Arrow UDFs."""
