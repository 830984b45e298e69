"""rillmark: layered real-time warehouse operators as plain Spark DataFrame functions."""
