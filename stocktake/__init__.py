"""Content-addressed inventory analytics as composable Spark DataFrame operators."""
