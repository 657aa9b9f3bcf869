"""Document-flow analytics as Spark DataFrame operators."""
