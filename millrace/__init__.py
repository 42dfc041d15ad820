"""Medallion retail processing as plain Spark jobs."""
