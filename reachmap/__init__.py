"""Access-gap analytics as PySpark DataFrame operations."""
