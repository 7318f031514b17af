"""Column builders and Arrow UDFs for scalar work."""
