"""DataFrame -> DataFrame operators (lazy; built-in Spark expressions only)."""
