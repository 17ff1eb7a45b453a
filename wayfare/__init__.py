"""Urban mobility analytics as plain Spark DataFrame transformations."""
