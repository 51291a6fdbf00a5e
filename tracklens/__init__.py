"""Issue-tracker analytics as Spark DataFrame operators."""
