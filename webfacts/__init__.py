"""Web pages to scored facts, as composable Spark DataFrame operators."""
