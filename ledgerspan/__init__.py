"""Premium analytics as Spark DataFrame operators."""
