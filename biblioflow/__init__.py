"""biblioflow: bibliographic analytics as composable Spark DataFrame operators."""
