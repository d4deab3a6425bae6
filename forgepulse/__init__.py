"""Repository-event analytics as Spark DataFrame operators."""
