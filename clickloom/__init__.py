"""E-commerce click analytics as plain Spark DataFrame transformations."""
