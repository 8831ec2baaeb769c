"""Head-to-head results analytics as Spark DataFrame operators."""
