"""Position-by-sample matrix analytics as Spark DataFrame operators."""
