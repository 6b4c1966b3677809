"""Column builders that stay inside Catalyst wherever Spark has the built-in."""
