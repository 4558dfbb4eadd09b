"""Column -> Column helpers. Everything here is a built-in Spark expression."""
