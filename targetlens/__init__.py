"""Target-discovery analytics as composable PySpark operators."""
