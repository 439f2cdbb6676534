"""Cell-by-gene analytics as Spark DataFrame operators."""
